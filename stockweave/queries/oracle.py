"""The same answers in DuckDB SQL over the same tables.

Every oracle is written on its own terms: joins per identifier type where the
Spark side has one lookup, one aggregate per measure where it has one pass.
"""

from __future__ import annotations

# ---------------------------------------------------------------- inputs

_EXTRACTS = """
style AS (
  SELECT p_partkey AS pk, 'S' || p_partkey AS sku,
         'ST' || (p_partkey // 8) || CASE (p_partkey // 8) % 4 WHEN 0 THEN '-AW24' WHEN 1 THEN '-SS25' WHEN 2 THEN '-AW' ELSE '' END AS style_code,
         p_retailprice AS mrp, p_type, p_size
  FROM part),
ids AS (
  SELECT 'sku_code' AS t, 1 AS pr, 'S' || pk AS v, sku, style_code, pk FROM style
  UNION ALL SELECT 'az_asin', 2, 'B' || pk, sku, style_code, pk FROM style WHERE pk % 2 = 0
  UNION ALL SELECT 'fk_sku', 3, 'F' || pk, sku, style_code, pk FROM style WHERE pk % 3 = 0),
styles AS (SELECT DISTINCT style_code FROM style),
best AS (
  SELECT v, t, sku, style_code FROM
    (SELECT *, row_number() OVER (PARTITION BY v ORDER BY pr, pk) AS rn FROM ids) WHERE rn = 1),
channels(ledger, channel, channel_type, flow) AS (VALUES
  ('1-URGENT/A', 'Amazon Vendor Central', 'marketplace', 'sell_out'),
  ('1-URGENT/R', 'Amazon Vendor Central', 'marketplace', 'sell_out'),
  ('1-URGENT/N', 'D2C Website', 'd2c', 'sell_out'),
  ('2-HIGH/A', 'Myntra', 'marketplace', 'sell_in'),
  ('2-HIGH/R', 'Myntra', 'marketplace', 'sell_in'),
  ('2-HIGH/N', 'Amazon Vendor Central', 'marketplace', 'sell_in'),
  ('3-MEDIUM/A', 'All Sports', 'retail_store', 'sell_out'),
  ('3-MEDIUM/R', 'Jack & Jill', 'retail_store', 'sell_in'),
  ('3-MEDIUM/N', 'INCS', 'retail_store', 'sell_out'),
  ('4-NOT SPECIFIED/A', 'Promotions', 'internal', 'exclude'),
  ('4-NOT SPECIFIED/R', 'Promotions', 'internal', 'exclude'),
  ('4-NOT SPECIFIED/N', 'Promotions', 'internal', 'exclude')),
sx AS (
  SELECT 'sales_' || o_orderpriority || '.csv' AS source_file, o_orderpriority || '/' || l_returnflag AS ledger,
         'LOC' || (l_suppkey % 5) AS location, l_shipdate AS d,
         upper(CASE WHEN l_linenumber % 4 = 0 THEN 's' || l_partkey WHEN l_linenumber % 4 = 1 THEN 'B' || l_partkey
              WHEN l_linenumber % 4 = 2 THEN 'f' || l_partkey
              WHEN l_partkey % 2 = 0 THEN 'ST' || (l_partkey // 8) || CASE (l_partkey // 8) % 4 WHEN 0 THEN '-AW24' WHEN 1 THEN '-SS25' WHEN 2 THEN '-AW' ELSE '' END
              ELSE 'X' || l_partkey END) AS external_id,
         l_quantity AS qty, CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0.0::DOUBLE END AS ret,
         CASE WHEN l_linenumber <> 7 THEN l_extendedprice END AS gross,
         CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linestatus = 'O' AND l_tax = 0 THEN 0.0::DOUBLE
              ELSE l_extendedprice * (1::DOUBLE - l_discount) END AS net,
         CASE WHEN l_returnflag = 'R' THEN l_extendedprice END AS ret_value
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
ix AS (
  SELECT 'stock_' || (l_suppkey % 5) || '.csv' AS source_file,
         CASE l_suppkey % 5 WHEN 0 THEN 'Warehouse' WHEN 1 THEN 'All Sports' WHEN 2 THEN 'Jack & Jill' WHEN 3 THEN 'Amazon Vendor Central' ELSE 'INCS' END AS channel,
         CASE l_suppkey % 5 WHEN 0 THEN 'warehouse' WHEN 3 THEN 'marketplace' ELSE 'retail_store' END AS channel_type,
         'LOC' || (l_suppkey % 5) AS location, l_shipdate AS snapshot_date, l_linenumber = 7 AS lost,
         CASE WHEN l_linenumber = 7 THEN 'X' ELSE 'S' END || l_partkey AS external_id, l_partkey AS pk,
         floor(l_quantity * (l_partkey % 4) / 40)::DOUBLE AS qty,
         CASE WHEN l_suppkey % 5 IN (0, 3) THEN l_extendedprice END AS value
  FROM lineitem),
px AS (
  SELECT 'Purchase_Orders_history.csv' AS source_file, 'PO' || l_orderkey AS po_code,
         CASE WHEN l_linestatus = 'F' THEN 'Complete' WHEN l_tax = 0.08::DOUBLE THEN 'CANCELLED' ELSE 'Approved' END AS po_status,
         CASE WHEN l_partkey % 5 < 3 THEN l_shipdate - to_days(l_quantity::INT) END AS created,
         l_shipdate AS delivery_date, CASE WHEN l_suppkey % 10 <> 0 THEN 'Supplier ' || l_suppkey END AS vendor,
         CASE WHEN l_suppkey % 10 <> 0 THEN 'loc' || (l_suppkey % 5) END AS facility,
         CASE WHEN l_linenumber = 7 THEN 'X' ELSE 'S' END || l_partkey AS external_id, l_linenumber = 7 AS lost, l_partkey AS pk,
         l_quantity AS ordered,
         CASE WHEN l_linestatus = 'F' THEN l_quantity WHEN l_tax >= 0.04::DOUBLE THEN floor(l_quantity / 2) ELSE 0.0::DOUBLE END AS received,
         CASE WHEN l_returnflag = 'R' AND l_tax = 0.01::DOUBLE THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS rejected,
         l_extendedprice AS sub_total, l_extendedprice * (1::DOUBLE + l_tax) AS total,
         date_diff('day', l_shipdate, TIMESTAMP '2001-08-01')::DOUBLE AS ageing
  FROM lineitem)
"""

_FACTS = """
placed AS (
  SELECT sx.*, coalesce(c.channel, sx.ledger) AS channel, coalesce(c.channel_type, 'unknown') AS channel_type,
         coalesce(c.flow, 'unknown') AS flow
  FROM sx LEFT JOIN channels c ON c.ledger = sx.ledger),
sr AS (
  SELECT p.*,
         CASE WHEN i.v IS NOT NULL THEN 'az_asin' WHEN b.v IS NOT NULL THEN b.t WHEN s.style_code IS NOT NULL THEN 'style_code' END AS via,
         coalesce(i.sku, b.sku) AS sku,
         CASE WHEN i.v IS NOT NULL THEN i.style_code WHEN b.v IS NOT NULL THEN b.style_code ELSE s.style_code END AS style_code
  FROM placed p
  LEFT JOIN (SELECT * FROM ids WHERE t = 'az_asin') i ON i.v = p.external_id
  LEFT JOIN best b ON b.v = p.external_id
  LEFT JOIN styles s ON s.style_code = p.external_id),
s0 AS (
  SELECT sr.*, y.mrp, (net IS NULL OR net = 0) AS blank FROM sr LEFT JOIN style y ON y.sku = sr.sku),
fs AS (
  SELECT * EXCLUDE (net, mrp, blank),
         CASE WHEN blank AND gross <> 0 THEN gross WHEN blank AND mrp IS NOT NULL AND qty IS NOT NULL THEN qty * mrp ELSE net END AS net,
         CASE WHEN blank AND gross <> 0 THEN 'gross_fallback' WHEN blank AND mrp IS NOT NULL AND qty IS NOT NULL THEN 'imputed_mrp' ELSE 'as_reported' END AS basis
  FROM s0),
fi AS (SELECT ix.*, CASE WHEN NOT lost THEN y.sku END AS sku, CASE WHEN NOT lost THEN y.style_code END AS style_code FROM ix JOIN style y ON y.pk = ix.pk),
fp AS (SELECT px.*, ordered - received AS pending, CASE WHEN NOT lost THEN y.sku END AS sku, CASE WHEN NOT lost THEN y.style_code END AS style_code
       FROM px JOIN style y ON y.pk = px.pk),
mapped AS (SELECT * FROM fs WHERE sku IS NOT NULL AND flow IN ('sell_in', 'sell_out'))
"""

_BASE = "WITH " + _EXTRACTS.strip() + ",\n" + _FACTS.strip()


def _money(x: str) -> str:
    """Exact sum of money, 0 when there is nothing."""
    return f"coalesce(sum(({x})::DECIMAL(38,8)), 0)::DOUBLE"


def _units(x: str) -> str:
    return f"coalesce(sum({x}), 0)::DOUBLE"


def _rint(x: str, n: int = 0) -> str:
    """Half-even rounding on the scaled double."""
    k = f"{10**n}::DOUBLE"
    return f"(round_even(({x}) * {k}, 0) / {k} + 0::DOUBLE)"


def _pct(a: str, b: str) -> str:
    return _rint(f"({a})::DOUBLE / nullif(({b})::DOUBLE, 0) * 100::DOUBLE", 1)


def _bucket(days: str) -> str:
    return (f"CASE WHEN ({days}) IS NULL THEN NULL WHEN ({days}) <= 31 THEN '0-1 month' WHEN ({days}) <= 92 THEN '1-3 months' "
            f"WHEN ({days}) <= 183 THEN '3-6 months' WHEN ({days}) <= 274 THEN '6-9 months' WHEN ({days}) <= 365 THEN '9-12 months' "
            f"WHEN ({days}) <= 730 THEN '>1 year' ELSE '>2 years' END")


def _movement(st: str, b: str) -> str:
    e = f"(CASE {b} WHEN '0-1 month' THEN 0.2::DOUBLE WHEN '1-3 months' THEN 0.4::DOUBLE ELSE 0.46::DOUBLE END)"
    return (f"CASE WHEN ({st}) IS NULL OR {b} IS NULL THEN NULL WHEN ({st}) <= 0 THEN 'No Movement' "
            f"WHEN ({st}) < {e} * 0.75::DOUBLE THEN 'Slow Movement' WHEN ({st}) <= {e} * 1.25::DOUBLE THEN 'Good Movement' ELSE 'Fast Movement' END")


def _status(inv: str, rate: str) -> str:
    return (f"CASE WHEN ({inv}) IS NULL OR ({inv}) <= 0 THEN 'no stock' WHEN ({rate}) IS NULL OR ({rate}) <= 0 THEN (CASE WHEN ({inv}) > 3 THEN 'over stock' ELSE 'in stock' END) "
            f"WHEN ({inv}) / ({rate}) < 1.5 THEN 'low stock' WHEN ({inv}) / ({rate}) < 3 THEN 'in stock' ELSE 'over stock' END")


def _fmt(x: str) -> str:
    return f"CASE WHEN ({x}) IS NULL THEN '—' WHEN abs({x}) >= 10 THEN format('{{:,.0f}}', ({x})::DOUBLE) ELSE format('{{:,.1f}}', ({x})::DOUBLE) END"


_NOTES = """
notes AS (
  SELECT pk, CASE WHEN p_size = 40 THEN '' ELSE sku END AS sku, style_code,
         CASE p_size WHEN 10 THEN 'Watch' WHEN 12 THEN 'Repeat' WHEN 40 THEN 'Style hold' ELSE '' END AS n1,
         CASE p_size WHEN 10 THEN 'Ordered ' WHEN 20 THEN 'PO raised' ELSE '' END AS n2
  FROM style),
sku_note AS (SELECT sku, n1, n2 FROM notes WHERE sku <> '' AND (n1 <> '' OR n2 <> '')),
style_note AS (
  SELECT style_code, arg_min(n1, pk) AS n1, arg_min(n2, pk) AS n2 FROM notes WHERE sku = '' AND (n1 <> '' OR n2 <> '') GROUP BY 1)
"""


def _svs(asof: str, tag: str = "") -> str:
    """The SKU table, one aggregate per measure group, as CTEs ending in sv<tag>."""
    d = f"TIMESTAMP '{asof}'"
    p0, r0 = f"({d} - INTERVAL 59 DAY)", f"({d} - INTERVAL 14 DAY)"
    per, rec = f"d >= {p0} AND d <= {d}", f"d >= {r0} AND d <= {d}"
    az = "channel = 'Amazon Vendor Central'"
    rt = "channel_type = 'retail_store'"
    ot = f"NOT ({az}) AND NOT ({rt})"

    def s(x, cond):
        return f"coalesce(sum({x}) FILTER (WHERE {cond}), 0)::DOUBLE"

    return f"""
so{tag} AS (
  SELECT sku, {s('qty', f'{per} AND {az}')} AS amazon_sold, {s('ret', f'{per} AND {az}')} AS amazon_ret,
         {s('qty', f'{per} AND {rt}')} AS retail, {s('qty', f'{per} AND {ot}')} AS sale, {s('ret', f'{per} AND {ot}')} AS ret,
         {s('qty', rec)} AS recent_sold, {s('ret', rec)} AS recent_ret, {_units('qty')} AS all_sold, {_units('ret')} AS overall_ret,
         min(d) AS first_sale, {_money('net')} AS so_net
  FROM fs WHERE flow = 'sell_out' AND sku IS NOT NULL GROUP BY 1),
iv{tag} AS (
  SELECT sku, {s('qty', "channel = 'All Sports'")} AS all_sports_inv, {s('qty', "channel = 'Jack & Jill'")} AS jj_inv,
         {s('qty', az)} AS or_inv, {s('qty', "channel = 'Warehouse'")} AS d8_inv, {s('qty', "channel = 'INCS'")} AS incs_inv,
         sum(value::DECIMAL(38,8))::DOUBLE AS stock_value
  FROM fi WHERE sku IS NOT NULL GROUP BY 1),
pu{tag} AS (SELECT sku, {_units('ordered')} AS purchase_qty, min(created) AS first_po FROM fp WHERE sku IS NOT NULL GROUP BY 1),
uni{tag} AS (SELECT DISTINCT sku FROM (SELECT sku FROM fs UNION ALL SELECT sku FROM fi UNION ALL SELECT sku FROM fp) WHERE sku IS NOT NULL),
has{tag} AS (SELECT DISTINCT sku FROM (SELECT sku FROM fs UNION ALL SELECT sku FROM fi)),
v0{tag} AS (
  SELECT u.sku, CASE WHEN h.sku IS NOT NULL THEN y.style_code END AS style,
         CASE WHEN y.p_size <= 45 THEN y.p_type END AS category,
         CASE y.p_size % 3 WHEN 0 THEN 'Men' WHEN 1 THEN 'Women' ELSE 'Unisex' END AS gender,
         CASE WHEN y.p_size <= 40 THEN y.p_size % 10 + 1990 END AS yr,
         coalesce(all_sports_inv, 0) AS all_sports_inv, coalesce(jj_inv, 0) AS jj_inv, coalesce(or_inv, 0) AS or_inv,
         coalesce(incs_inv, 0) AS incs_inv, coalesce(d8_inv, 0) AS d8_inv, 0.0::DOUBLE AS cb_rtv, stock_value,
         coalesce(sale, 0) AS sale, coalesce(ret, 0) AS ret, coalesce(amazon_sold, 0) AS amazon_sold, coalesce(amazon_ret, 0) AS amazon_ret,
         coalesce(retail, 0) AS retail, coalesce(recent_sold, 0) AS recent_sold, coalesce(recent_ret, 0) AS recent_ret,
         coalesce(all_sold, 0) AS all_sold, coalesce(overall_ret, 0) AS overall_ret, coalesce(so_net, 0) AS so_net,
         coalesce(purchase_qty, 0) AS purchase_qty, first_po, first_sale
  FROM uni{tag} u JOIN style y ON y.sku = u.sku LEFT JOIN has{tag} h ON h.sku = u.sku
  LEFT JOIN so{tag} so ON so.sku = u.sku LEFT JOIN iv{tag} iv ON iv.sku = u.sku LEFT JOIN pu{tag} pu ON pu.sku = u.sku),
v1{tag} AS (
  SELECT *, d8_inv + cb_rtv AS d8_inv_rtv, all_sports_inv + jj_inv + or_inv + incs_inv + d8_inv + cb_rtv AS total_inventory,
         ret + amazon_ret AS returns, sale + amazon_sold + retail - (ret + amazon_ret) AS net_sale, all_sold - overall_ret AS overall_net,
         CASE WHEN coalesce(style, sku) LIKE '%-AW24' THEN TIMESTAMP '2024-08-01' WHEN coalesce(style, sku) LIKE '%-SS25' THEN TIMESTAMP '2025-02-01'
              WHEN coalesce(style, sku) LIKE '%-AW' THEN TIMESTAMP '2023-08-01' END AS season,
         CASE WHEN yr IS NOT NULL THEN make_timestamp(yr::BIGINT, 7, 1, 0, 0, 0) END AS year_date
  FROM v0{tag}),
v2{tag} AS (
  SELECT *, coalesce(first_po, first_sale, season, year_date) AS first_seen,
         CASE WHEN first_po IS NOT NULL THEN 'first PO date' WHEN first_sale IS NOT NULL THEN 'first sale date'
              WHEN season IS NOT NULL THEN 'season code' WHEN year_date IS NOT NULL THEN 'product year' ELSE 'unknown' END AS ageing_basis,
         net_sale / 2 AS avg_month, net_sale / 2 AS ros_month, net_sale / 2 * 3 AS projection, net_sale / 2 * 3 AS for_3_months,
         recent_sold * 2 AS monthly_ros, net_sale / nullif(net_sale + total_inventory, 0) AS sell_through,
         overall_net / nullif(purchase_qty, 0) AS on_po, overall_net / nullif(overall_net + total_inventory, 0) AS est
  FROM v1{tag}),
v3{tag} AS (
  SELECT *, {_bucket(f"date_diff('day', first_seen, {d})")} AS ageing, coalesce(on_po, est) AS overall_st,
         CASE WHEN on_po IS NOT NULL THEN 'purchase qty' WHEN est IS NOT NULL THEN 'sold + stock (estimate)' ELSE 'unknown' END AS st_basis
  FROM v2{tag}),
sv{tag} AS (
  SELECT v.*, {_movement('overall_st', 'ageing')} AS overall_movement, {_movement('sell_through', 'ageing')} AS movement,
         CASE WHEN total_inventory <= projection THEN 'REORDER' ELSE 'IN-STOCK' END AS inv_level,
         {_status('total_inventory', 'monthly_ros')} AS inventory_status,
         CASE WHEN coalesce(a.n1, '') <> '' THEN a.n1 ELSE coalesce(b.n1, '') END AS style_status,
         CASE WHEN coalesce(a.n2, '') <> '' THEN a.n2 ELSE coalesce(b.n2, '') END AS reorder_status
  FROM v3{tag} v LEFT JOIN sku_note a ON a.sku = v.sku LEFT JOIN style_note b ON b.style_code = v.style)"""


_SKU_BASE = _BASE + ",\n" + _NOTES.strip() + "," + _svs("2001-08-01")

_ARTICLE = f"""
ar0 AS (
  SELECT style, {', '.join(f'sum({c}) AS {c}' for c in ('total_inventory', 'd8_inv', 'all_sports_inv', 'jj_inv', 'or_inv', 'incs_inv', 'net_sale', 'returns', 'purchase_qty', 'overall_net', 'overall_ret', 'recent_sold', 'recent_ret'))},
         arg_min(category, sku) AS category_any, arg_min(gender, sku) AS gender,
         count(*)::BIGINT AS sizes, (count(*) FILTER (WHERE total_inventory > 0))::BIGINT AS sizes_in_stock, min(first_seen) AS first_seen
  FROM sv WHERE style IS NOT NULL GROUP BY 1),
first_size AS (SELECT style, category FROM (SELECT style, category, row_number() OVER (PARTITION BY style ORDER BY sku) AS rn FROM sv WHERE style IS NOT NULL) WHERE rn = 1),
oldest AS (SELECT style, ageing_basis FROM (SELECT style, ageing_basis, row_number() OVER (PARTITION BY style ORDER BY first_seen, sku) AS rn FROM sv WHERE style IS NOT NULL AND first_seen IS NOT NULL) WHERE rn = 1),
lift AS (SELECT style, n1 AS lifted FROM (SELECT style, style_status AS n1, row_number() OVER (PARTITION BY style ORDER BY count(*) DESC, style_status) AS rn
          FROM sv WHERE style IS NOT NULL AND style_status <> '' GROUP BY 1, 2) WHERE rn = 1),
ar1 AS (
  SELECT ar0.*, f.category, o.ageing_basis, {_bucket("date_diff('day', ar0.first_seen, TIMESTAMP '2001-08-01')")} AS ageing,
         net_sale / 2 AS ros_month, recent_sold * 2 AS monthly_ros, net_sale / 2 * 3 AS for_3_months,
         net_sale / nullif(net_sale + total_inventory, 0) AS sell_through,
         coalesce(overall_net / nullif(purchase_qty, 0), overall_net / nullif(overall_net + total_inventory, 0)) AS overall_st,
         CASE WHEN purchase_qty <> 0 THEN 'purchase qty' WHEN overall_net + total_inventory <> 0 THEN 'sold + stock (estimate)' ELSE 'unknown' END AS st_basis,
         overall_ret / nullif(overall_net + overall_ret, 0) AS ret_pct
  FROM ar0 JOIN first_size f ON f.style = ar0.style LEFT JOIN oldest o ON o.style = ar0.style),
ar2 AS (SELECT *, {_movement('overall_st', 'ageing')} AS overall_movement, {_movement('sell_through', 'ageing')} AS movement FROM ar1),
rk(m, r) AS (VALUES ('No Movement', 0), ('Slow Movement', 1), ('Good Movement', 2), ('Fast Movement', 3)),
ar AS (
  SELECT a.*, CASE WHEN x.r > y.r THEN 'Improving' WHEN x.r < y.r AND y.r >= 2 THEN 'Slowing Down' WHEN x.r < y.r THEN 'Recovering' WHEN x.r = y.r THEN 'Stable' END AS stability,
         CASE WHEN total_inventory <= for_3_months THEN 'reorder' ELSE 'in-stock' END AS inv_level,
         {_status('total_inventory', 'monthly_ros')} AS inventory_status,
         coalesce(n.n1, l.lifted, '') AS style_status, coalesce(n.n2, '') AS reorder_status
  FROM ar2 a LEFT JOIN rk x ON x.m = a.movement LEFT JOIN rk y ON y.m = a.overall_movement
  LEFT JOIN style_note n ON n.style_code = a.style LEFT JOIN lift l ON l.style = a.style)
"""
_ART_BASE = _SKU_BASE + ",\n" + _ARTICLE.strip()


def _alerts(tag: str = "") -> str:
    """Alert frame and all eight rules as CTEs ending in al<tag>."""
    cols = "alert, label, severity, sku, item, category, stock, monthly_ros, cover_days, sell_through, return_rate, ageing, movement, value_at_risk, revenue_at_risk, value_basis"

    def rule(name, label, sev, rank, cond, why):
        return (f"SELECT '{name}' AS alert, '{label}' AS label, '{sev}' AS severity, pf{tag}.*, {why} AS reason, {rank} AS priority, '{rank}' AS money_col "
                f"FROM pf{tag} WHERE {cond}")

    st = _fmt("sell_through * 100")
    rules = [
        rule("out_of_stock", "Out of stock", "high", "revenue_at_risk", "stock <= 0 AND demand_rate >= 0.5",
             f"'sells ~' || ({_fmt('demand_rate')}) || '/month, stock is zero'"),
        rule("low_stock", "Low stock", "high", "revenue_at_risk",
             "stock > 0 AND ((cover_days < 21 AND demand_rate >= 0.5) OR inv_status = 'low stock')",
             f"CASE WHEN cover_days < 21 AND demand_rate >= 0.5 THEN ({_fmt('cover_days')}) || ' days of cover left (floor is 21)' ELSE 'flagged low stock in the workbook' END"),
        rule("reorder_level", "Reorder level reached", "medium", "revenue_at_risk",
             "inv_level = 'REORDER' AND lower(trim(reorder_status)) NOT IN ('ordered', 'po raised', 'done', 'actioned', 'no')",
             f"'at reorder point — ' || ({_fmt('stock')}) || ' on hand vs ' || ({_fmt('for_3_months')}) || ' needed for 3 months'"),
        rule("best_sellers", "Best sellers", "info", "revenue_at_risk", "movement = 'Fast Movement' AND net_sale >= 5",
             f"({_fmt('net_sale')}) || ' sold this period, sell-through ' || ({st}) || '%'"),
        rule("high_returns", "High returns", "high", "value_at_risk", "return_rate > 0.15::DOUBLE AND overall_sale + overall_ret >= 5",
             f"({_fmt('return_rate * 100')}) || '% returned (' || ({_fmt('overall_ret')}) || ' of ' || ({_fmt('overall_sale + overall_ret')}) || ')'"),
        rule("slow_moving", "Slow moving", "medium", "value_at_risk", "movement = 'Slow Movement' AND value_at_risk >= 5000",
             f"'sell-through ' || ({st}) || '% against its ' || ageing || ' age'"),
        rule("dead_stock", "Dead stock", "high", "value_at_risk", "movement = 'No Movement' AND ageing IN ('>1 year', '>2 years') AND stock >= 5",
             f"'no sales, ' || ({_fmt('stock')}) || ' units sitting ' || replace(ageing, '>', 'over ')"),
        rule("stock_ageing", "Stock ageing", "medium", "value_at_risk", "ageing = '>2 years' AND stock >= 5",
             f"({_fmt('stock')}) || ' units in the ' || ageing || ' bucket'"),
    ]
    return f"""
asp{tag} AS (SELECT coalesce(sum(so_net::DECIMAL(38,8))::DOUBLE / nullif(sum(all_sold), 0), 0) AS asp FROM sv{tag} WHERE all_sold > 0),
w0{tag} AS (
  SELECT sku, coalesce(style, '') AS item, coalesce(category, '') AS category, coalesce(gender, '') AS gender, coalesce(ageing, '') AS ageing,
         coalesce(movement, '') AS movement, coalesce(overall_movement, '') AS overall_movement, inv_level, inventory_status AS inv_status,
         trim(reorder_status) AS reorder_status, trim(style_status) AS style_reorder, total_inventory AS stock, monthly_ros, ros_month, net_sale, returns,
         overall_net AS overall_sale, overall_ret, coalesce(sell_through, 0) AS sell_through, recent_sold AS last15_sales, for_3_months, purchase_qty,
         CASE WHEN monthly_ros > 0 THEN monthly_ros ELSE ros_month END AS demand_rate,
         CASE WHEN stock_value > 0 THEN stock_value END AS reported,
         coalesce(CASE WHEN all_sold > 0 AND so_net / all_sold > 0 THEN so_net / all_sold END, asp) AS unit
  FROM sv{tag}, asp{tag}),
w1{tag} AS (
  SELECT *, demand_rate / 30 AS daily_rate, CASE WHEN demand_rate / 30 > 0 THEN stock / (demand_rate / 30) END AS cover_days,
         CASE WHEN overall_sale + overall_ret > 0 THEN overall_ret / (overall_sale + overall_ret) END AS return_rate,
         {_rint('coalesce(reported, stock * unit, 0)')} AS value_at_risk
  FROM w0{tag}),
w2{tag} AS (
  SELECT *, CASE WHEN value_at_risk > 0 THEN CASE WHEN reported IS NOT NULL THEN 'reported' ELSE 'estimated' END ELSE 'none' END AS value_basis,
         CASE WHEN stock > 0 THEN value_at_risk / stock ELSE unit END AS unit_price FROM w1{tag}),
pf{tag} AS (SELECT * EXCLUDE (unit, reported), {_rint('demand_rate * unit_price')} AS revenue_at_risk FROM w2{tag}),
al{tag} AS (SELECT {cols}, reason, priority, money_col, alert || '|' || sku AS key FROM (
  {' UNION ALL '.join(rules)}))"""


_ALERT_BASE = _SKU_BASE + "," + _alerts()
_TWO_RUNS = _BASE + ",\n" + _NOTES.strip() + "," + _svs("2001-08-01") + "," + _alerts() + "," + _svs("2001-06-01", "1") + "," + _alerts("1")
_SEV = "CASE severity WHEN 'high' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END"

ORACLE: dict[str, str] = {}


def _q(name: str, body: str, base: str = _BASE) -> None:
    ORACLE[name] = f"{base}\n{body}" if base else body


# ------------------------------------------------- resolution and facts

_q("resolve_identifiers", "SELECT external_id, 'az_asin' AS external_id_type, via AS matched_via, sku AS master_sku, style_code, count(*) AS rows FROM sr GROUP BY ALL")
_q("identifier_bridge", """
SELECT t AS identifier_type, v AS identifier_value, sku AS master_sku, style_code FROM ids
UNION ALL SELECT 'style_code', style_code, sku, style_code FROM style""")
_q("ledger_map", f"SELECT channel, channel_type, flow, count(*) AS rows, {_units('qty')} AS units FROM placed GROUP BY ALL")
_q("unknown_ledgers", "SELECT DISTINCT channel FROM fs WHERE flow = 'unknown'")
_q("facility_filter", f"SELECT facility, count(*) AS rows, {_units('ordered')} AS ordered FROM px WHERE facility IS NULL OR upper(facility) = 'LOC1' GROUP BY 1")
_q("facility_drops", """
SELECT source_file, count(*) AS rows_dropped,
       array_to_string(list_slice(list_sort(list_distinct(list(upper(facility)))), 1, 6), ', ') AS facilities_found, 'LOC1' AS scope
FROM px WHERE facility IS NOT NULL AND upper(facility) <> 'LOC1' GROUP BY 1""")
_q("value_basis_rows", "SELECT source_file, channel, external_id, sku AS master_sku, d AS period_start, qty AS qty_sold, net::DECIMAL(18,4)::DOUBLE AS net_value, basis AS value_basis FROM fs")
_q("value_basis", f"SELECT basis AS value_basis, count(*) AS rows, {_money('net')} AS value FROM fs GROUP BY 1")
_q("mrp_lookup", """
SELECT 'S' || l_partkey AS master_sku, l_extendedprice AS mrp FROM (
  SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, l_extendedprice DESC) AS rn FROM lineitem) WHERE rn = 1""", "")
_q("duplicate_master_skus", """
SELECT upper(p_brand || '-' || p_type || '-' || p_size) AS sku_code, upper(arg_min(p_name, p_partkey)) AS item_name, min(p_partkey) AS row_seq, count(*) AS copies
FROM part GROUP BY 1""", "")
_q("drop_total_rows", r"""
WITH lines AS (SELECT unnest(string_split(text, chr(10))) AS k FROM documents),
named AS (SELECT CASE WHEN length(k) % 50 = 0 THEN 'Grand Total ' || k ELSE k END AS k FROM lines)
SELECT count(*) AS rows, sum(length(k))::BIGINT AS chars FROM named
WHERE NOT regexp_matches(k, '(?i)grand\s*total|^total$|^sum\b')""", "")

# --------------------------------------------------------------- reports

_q("channel_report", f"""
SELECT flow, channel_type, channel, count(DISTINCT sku) AS skus, {_units('qty')} AS units, {_money('net')} AS net_value, {_money('gross')} AS gross_value
FROM mapped GROUP BY 1, 2, 3""")
_q("store_report", """
, pv AS (
  SELECT channel, location,
         sum(qty) FILTER (WHERE flow = 'sell_in') AS qi, sum(qty) FILTER (WHERE flow = 'sell_out') AS qo,
         (sum(coalesce(net, 0)::DECIMAL(38,8)) FILTER (WHERE flow = 'sell_in'))::DOUBLE AS ni,
         (sum(coalesce(net, 0)::DECIMAL(38,8)) FILTER (WHERE flow = 'sell_out'))::DOUBLE AS no
  FROM mapped WHERE channel_type = 'retail_store' GROUP BY 1, 2),
st AS (SELECT channel, location, sum(qty) AS stock FROM fi WHERE channel_type = 'retail_store' GROUP BY 1, 2)
SELECT pv.channel, pv.location, st.stock AS closing_stock, qi AS qty_sold_sell_in, qo AS qty_sold_sell_out, ni AS net_value_sell_in, no AS net_value_sell_out
FROM pv LEFT JOIN st ON st.channel = pv.channel AND st.location = pv.location""")
_q("sku_report", f"""
, k AS (
  SELECT sku, count(DISTINCT channel) AS channels, coalesce(sum(qty) FILTER (WHERE flow = 'sell_in'), 0) AS qi, coalesce(sum(qty) FILTER (WHERE flow = 'sell_out'), 0) AS qo,
         coalesce(sum(net::DECIMAL(38,8)) FILTER (WHERE flow = 'sell_in'), 0)::DOUBLE AS ni, coalesce(sum(net::DECIMAL(38,8)) FILTER (WHERE flow = 'sell_out'), 0)::DOUBLE AS no
  FROM mapped GROUP BY 1),
st AS (SELECT sku, sum(qty) AS stock FROM fi WHERE sku IS NOT NULL GROUP BY 1)
SELECT k.sku AS master_sku, y.style_code, channels, qi AS qty_sold_sell_in, qo AS qty_sold_sell_out, ni AS net_value_sell_in, no AS net_value_sell_out,
       coalesce(stock, 0) AS stock_on_hand, {_pct('qo', 'qo + coalesce(stock, 0)')} AS sell_through_pct
FROM k JOIN style y ON y.sku = k.sku LEFT JOIN st ON st.sku = k.sku""")
_q("po_vendor", f"""
SELECT vendor, po_status, count(DISTINCT po_code) AS pos, count(*) AS lines, {_units('ordered')} AS ordered, {_units('received')} AS received,
       {_units('pending')} AS pending, {_units('rejected')} AS rejected, {_money('total')} AS value,
       {_rint('sum(ageing) / count(ageing)', 1)} AS avg_ageing_days, {_pct('sum(received)', 'sum(ordered)')} AS fill_rate_pct
FROM fp GROUP BY 1, 2""")
_q("po_sku", f"""
, p AS (SELECT sku, {_units('pending')} AS on_order, {_units('ordered')} AS ordered_total, {_units('received')} AS received_total, {_money('total')} AS po_value FROM fp WHERE sku IS NOT NULL GROUP BY 1),
st AS (SELECT sku, sum(qty) AS stock FROM fi WHERE sku IS NOT NULL GROUP BY 1),
so AS (SELECT sku, sum(qty) AS sold FROM mapped WHERE flow = 'sell_out' GROUP BY 1)
SELECT p.sku AS master_sku, y.style_code, on_order, coalesce(stock, 0) AS stock_on_hand, coalesce(stock, 0) + on_order AS total_supply,
       coalesce(sold, 0) AS sell_out_units, ordered_total, received_total, po_value
FROM p JOIN style y ON y.sku = p.sku LEFT JOIN st ON st.sku = p.sku LEFT JOIN so ON so.sku = p.sku""")
_q("po_open_lines", """
SELECT po_code, po_status, vendor, external_id, sku AS master_sku, delivery_date, ordered AS qty_ordered, pending AS qty_pending, sub_total
FROM fp WHERE upper(po_status) NOT IN ('COMPLETE', 'COMPLETED', 'CANCELLED', 'CANCELED', 'CLOSED') AND pending > 0""")
_q("po_coverage", """
SELECT count(*) AS lines, count(sku) AS matched, count(DISTINCT sku) AS skus, count(DISTINCT external_id) FILTER (WHERE sku IS NULL) AS unknown_ids, count(*) - count(sku) AS dropped FROM fp""")
_q("inventory_position", f"SELECT channel, channel_type, location, count(DISTINCT sku) AS skus, {_units('qty')} AS units, {_money('value')} AS value FROM fi WHERE sku IS NOT NULL GROUP BY 1, 2, 3")
_q("period_coverage", "SELECT source_file, channel, 'day' AS grain, min(flow) AS flow, min(d) AS period_start, max(d) AS period_end, count(*) AS rows FROM fs GROUP BY 1, 2")
_q("snapshot_coverage", "SELECT source_file, channel, max(snapshot_date) AS snapshot_date, count(*) AS rows FROM fi GROUP BY 1, 2")
_q("returns_report", f"SELECT channel, channel_type, {_units('ret')} AS units_returned, {_money('ret_value')} AS returns_value, bool_or(sku IS NOT NULL) AS sku_level FROM fs WHERE ret <> 0 GROUP BY 1, 2")
_EXC = "'identifier not present in master mapping table' AS reason"
_q("exceptions", f"SELECT source_file, external_id, 'az_asin' AS declared_id_type, {_EXC}, {_units('qty')} AS qty, {_money('net')} AS value FROM sr WHERE via IS NULL GROUP BY 1, 2")
_q("po_exceptions", f"SELECT source_file, external_id, 'sku_code' AS declared_id_type, {_EXC}, {_units('ordered')} AS qty, {_money('total')} AS value FROM fp WHERE sku IS NULL GROUP BY 1, 2")
_q("load_audit", f"""
SELECT source_file, count(*) AS rows, count(via) AS matched, {_units('qty')} AS qty, {_money('net')} AS value, count(*) - count(via) AS unmatched,
       {_pct('count(via)', 'count(*)')} AS match_pct, 0::BIGINT AS rows_other_facility FROM sr GROUP BY 1""")
_q("load_audit_scoped", f"""
SELECT source_file, count(*) AS rows, count(sku) AS matched, {_units('ordered')} AS qty, {_money('total')} AS value, count(*) - count(sku) AS unmatched,
       {_pct('count(sku)', 'count(*)')} AS match_pct, (SELECT count(*) FROM px WHERE upper(facility) <> 'LOC1') AS rows_other_facility
FROM fp WHERE facility IS NULL OR upper(facility) = 'LOC1' GROUP BY 1""")
_q("summary", f"""
, o AS (SELECT * FROM fp WHERE upper(po_status) NOT IN ('COMPLETE', 'CANCELLED') AND pending > 0),
u AS (SELECT count(*) AS n FROM (SELECT DISTINCT source_file, external_id FROM fs WHERE via IS NULL UNION ALL
      SELECT DISTINCT source_file, external_id FROM fi WHERE sku IS NULL UNION ALL SELECT DISTINCT source_file, external_id FROM fp WHERE sku IS NULL)),
h AS (SELECT count(via) AS k, count(*) AS n FROM fs UNION ALL SELECT count(sku), count(*) FROM fi UNION ALL SELECT count(sku), count(*) FROM fp)
SELECT 'Sell-out units (end customers)' AS metric, (SELECT {_units('qty')} FROM mapped WHERE flow = 'sell_out') AS value_num, NULL::VARCHAR AS value_text
UNION ALL SELECT 'Sell-out value', (SELECT {_money('net')} FROM mapped WHERE flow = 'sell_out'), NULL
UNION ALL SELECT 'Sell-in units (invoiced to channels)', (SELECT {_units('qty')} FROM mapped WHERE flow = 'sell_in'), NULL
UNION ALL SELECT 'Sell-in value', (SELECT {_money('net')} FROM mapped WHERE flow = 'sell_in'), NULL
UNION ALL SELECT 'Channels', (SELECT count(DISTINCT channel) FROM mapped), NULL
UNION ALL SELECT 'Locations', (SELECT count(DISTINCT location) FROM mapped), NULL
UNION ALL SELECT 'SKUs with activity', (SELECT count(DISTINCT sku) FROM mapped), NULL
UNION ALL SELECT 'Stock on hand (units)', (SELECT {_units('qty')} FROM fi), NULL
UNION ALL SELECT 'Units on order (open POs)', (SELECT {_units('pending')} FROM o), NULL
UNION ALL SELECT 'Open PO value', (SELECT {_money('total')} FROM o), NULL
UNION ALL SELECT 'Identifier match rate %', (SELECT {_pct('sum(k)', 'sum(n)')} FROM h), NULL
UNION ALL SELECT 'Unmapped identifiers', (SELECT n FROM u), NULL
UNION ALL SELECT 'Files skipped', 0, NULL
UNION ALL SELECT 'Unmapped channel ledgers', (SELECT count(DISTINCT channel) FROM fs WHERE flow = 'unknown'), NULL
UNION ALL SELECT 'Files superseded (deduped)', 0, NULL
UNION ALL SELECT 'Rows dropped (other facility)', 0, NULL
UNION ALL SELECT 'Facility scope', NULL, 'all facilities'""")
_q("channel_pivot", f"""
SELECT channel, coalesce(sum(qty) FILTER (WHERE flow = 'sell_in'), 0) AS units_sell_in, coalesce(sum(qty) FILTER (WHERE flow = 'sell_out'), 0) AS units_sell_out,
       coalesce(sum(net::DECIMAL(38,8)) FILTER (WHERE flow = 'sell_in'), 0)::DOUBLE AS net_value_sell_in,
       coalesce(sum(net::DECIMAL(38,8)) FILTER (WHERE flow = 'sell_out'), 0)::DOUBLE AS net_value_sell_out
FROM mapped GROUP BY 1""")

# --------------------------------------------------------- merchandising

_q("sku_universe", "SELECT sku, style FROM sv", _SKU_BASE)
_q("inventory_columns", "SELECT sku, all_sports_inv AS all_sports, jj_inv AS jj, or_inv AS amazon, d8_inv AS warehouse, incs_inv AS incs, total_inventory AS total FROM sv", _SKU_BASE)
_q("period_sales", "SELECT sku, amazon_sold, amazon_ret, retail, sale AS other_sold, ret AS other_ret, net_sale, returns FROM sv", _SKU_BASE)
_q("recent_sales", "SELECT sku, recent_sold, recent_ret FROM sv", _SKU_BASE)
_q("overall_sales", "SELECT sku, overall_net AS net_units, overall_ret AS returned, purchase_qty AS purchased, first_po, first_sale FROM sv", _SKU_BASE)
_q("ageing_ladder", "SELECT sku, first_seen, ageing_basis AS basis, ageing FROM sv", _SKU_BASE)
_q("svs_sku", """
SELECT sku, style, category, gender, total_inventory, all_sports_inv, jj_inv, or_inv, incs_inv, d8_inv, d8_inv_rtv, cb_rtv, sale, ret, amazon_sold, amazon_ret, retail,
       net_sale, returns, avg_month, projection, purchase_qty, sell_through, overall_net, overall_ret, overall_st, st_basis, ros_month, recent_sold, recent_ret, monthly_ros,
       ageing, ageing_basis, overall_movement, inv_level, movement, style_status, for_3_months, inventory_status, reorder_status FROM sv""", _SKU_BASE)
_q("svs_article", """
SELECT style, category, gender, total_inventory, sizes, sizes_in_stock, net_sale, returns, ret_pct, ros_month, monthly_ros, purchase_qty, sell_through, recent_sold, overall_net,
       overall_ret, overall_st, st_basis, ageing, ageing_basis, overall_movement, inv_level, movement, stability, style_status, for_3_months, inventory_status, reorder_status FROM ar""", _ART_BASE)
_q("sku_sheet", """
SELECT sku AS "Sku Code", style AS "Item Name", category AS "Category", total_inventory AS "Total Inventory", all_sports_inv AS "all sports inv", jj_inv AS "J&J Inv", or_inv AS "OR inv",
       d8_inv_rtv AS "d8 inv + rtv", d8_inv AS "D8 inv", cb_rtv AS "CB rtv", sale AS "Sale (Jun-Aug )", ret AS "Ret", amazon_sold AS "Coco-OR SALES", amazon_ret AS "Coco-OR RET",
       retail AS "Retail (Jun-Aug)", net_sale AS "Net sale (Jun-Aug )", returns AS "Returns (Jun-Aug )", avg_month AS "avg", projection AS "Sale Projection for next 3 month",
       purchase_qty AS "Purchase. qty", sell_through AS "Sell through (Jun-Aug)", overall_net AS "overall net sale qty", overall_ret AS "Overall ret", overall_st AS "Overall Sell-through",
       ros_month AS "ros/month", recent_sold AS "Last 15 days Sales", recent_ret AS "Last 15 days Returns", monthly_ros AS "monthly ros", ageing AS "Ageing", overall_movement AS "Overall Movement",
       inv_level AS "Inv. Level", movement AS "Movement", style_status AS "Style Re-order Status", for_3_months AS "For 3 months", inventory_status AS "Inventory status",
       reorder_status AS "Reorder Status", gender AS "Gender", incs_inv AS "INCS inv", ageing_basis AS "Ageing basis", st_basis AS "Sell-through basis" FROM sv""", _SKU_BASE)
_q("article_sheet", """
SELECT style AS "Item Name", category AS "Category", gender AS "Gender", total_inventory AS "Total Inventory", d8_inv AS "d8 Inv + RTV", d8_inv AS "d8 Inventory", net_sale AS "Net sale (Jun-Aug)",
       returns AS "Reurns (Jun-Aug 15)", ros_month AS "ros/month", purchase_qty AS "Purchase. qty", sell_through AS "Sell through", recent_sold AS "Last 15 days sales", recent_ret AS "Last 15 daysRet",
       monthly_ros AS "ros/ month ( Based on last 15 days)", overall_net AS "overall net sale qty", overall_ret AS "overall ret qty", overall_st AS "Overall Sell-through", ret_pct AS "Ret %",
       ageing AS "Ageing", overall_movement AS "overall Movement", inv_level AS "Inv. Level", movement AS "Movement", stability AS "Movement Stability", style_status AS "Style Status",
       for_3_months AS "For 3 months", inventory_status AS "Inventory status", reorder_status AS "Re-order Status", all_sports_inv AS "all sports inv", jj_inv AS "J&J Inv", or_inv AS "OR inv",
       incs_inv AS "INCS inv", 0.0::DOUBLE AS "CB rtv", sizes AS "sizes", sizes_in_stock AS "sizes in stock", ageing_basis AS "Ageing basis", st_basis AS "Sell-through basis" FROM ar""", _ART_BASE)
_q("action_list", """
, act AS (
  SELECT *, CASE WHEN movement IN ('Good Movement', 'Fast Movement') AND inventory_status IN ('no stock', 'low stock') THEN 'REORDER'
              WHEN movement IN ('Good Movement', 'Fast Movement') AND sizes_in_stock < sizes * 0.5 THEN 'SIZE BREAK'
              WHEN movement = 'No Movement' AND inventory_status = 'over stock' THEN 'CLEAR' END AS action FROM ar)
SELECT action, CASE action
         WHEN 'REORDER' THEN movement || ', ' || inventory_status || ', ' || round_even(for_3_months, 0)::BIGINT || ' units projected for 3 months vs ' || round_even(total_inventory, 0)::BIGINT || ' in stock'
         WHEN 'SIZE BREAK' THEN sizes_in_stock || ' of ' || sizes || ' sizes in stock on a ' || lower(movement) || ' style'
         ELSE 'no sales in the window, ' || round_even(total_inventory, 0)::BIGINT || ' units on hand, aged ' || ageing END AS why,
       style AS item_name, category, gender, total_inventory, sizes, sizes_in_stock, net_sale, ros_month, for_3_months, ageing, movement, overall_movement, inventory_status,
       inv_level, style_status, reorder_status FROM act WHERE action IS NOT NULL""".replace("reorder_status FROM act", "reorder_status AS re_order_status FROM act").replace("re_order_status", "re_order_status"), _ART_BASE)
_q("report_slice", "SELECT sku, category, movement, inventory_status, total_inventory FROM sv WHERE category IN ('ECONOMY', 'PROMO') AND inventory_status IN ('over stock', 'low stock')", _SKU_BASE)
_q("class_distributions", " UNION ALL ".join(
    f"SELECT '{name}' AS \"column\", {col} AS value, count(*) AS skus FROM sv GROUP BY 2"
    for name, col in (("Movement", "movement"), ("Overall Movement", "overall_movement"), ("Inventory status", "inventory_status"),
                      ("Inv. Level", "inv_level"), ("Ageing", "ageing"), ("Ageing basis", "ageing_basis"), ("Sell-through basis", "st_basis"))), _SKU_BASE)
_q("sku_caveats", """
SELECT count(*) AS skus, count(*) FILTER (WHERE purchase_qty = 0) AS without_po, count(*) FILTER (WHERE ageing IS NULL) AS without_age,
       count(*) FILTER (WHERE category IS NULL) AS without_category, (SELECT count(*) FROM fp) AS po_lines FROM sv""", _SKU_BASE)
_q("movement_criteria", """
, c(bucket_order, ageing, expected, slow_below, good_to) AS (VALUES (0, '0-1 month', 0.2::DOUBLE, 0.15::DOUBLE, 0.25::DOUBLE), (1, '1-3 months', 0.4, 0.3, 0.5), (2, '3-6 months', 0.46, 0.345, 0.575),
  (3, '6-9 months', 0.46, 0.345, 0.575), (4, '9-12 months', 0.46, 0.345, 0.575), (5, '>1 year', 0.46, 0.345, 0.575), (6, '>2 years', 0.46, 0.345, 0.575))
SELECT c.ageing, bucket_order, expected, 0.0::DOUBLE AS no_movement_to, slow_below, good_to, count(sv.sku) AS skus FROM c LEFT JOIN sv ON sv.ageing = c.ageing GROUP BY ALL""", _SKU_BASE)
_NOTE_BASE = _BASE + ",\n" + _NOTES.strip() + """,
ov AS (SELECT y.sku, y.style_code AS style, CASE WHEN coalesce(a.n1, '') <> '' THEN a.n1 ELSE coalesce(b.n1, '') END AS style_status,
       CASE WHEN coalesce(a.n2, '') <> '' THEN a.n2 ELSE coalesce(b.n2, '') END AS reorder_status
  FROM style y LEFT JOIN sku_note a ON a.sku = y.sku LEFT JOIN style_note b ON b.style_code = y.style_code)"""
_q("override_cascade", "SELECT * FROM ov", _NOTE_BASE)
_q("override_lift", """
SELECT style, style_status AS lifted_note FROM (SELECT style, style_status, row_number() OVER (PARTITION BY style ORDER BY count(*) DESC, style_status) AS rn
  FROM ov WHERE style_status <> '' GROUP BY 1, 2) WHERE rn = 1""", _NOTE_BASE)

# ------------------------------------------------ class and date functions

_AGE = "date_diff('day', l_shipdate, TIMESTAMP '2001-08-01')"
_q("ageing_bucket", f"SELECT {_bucket(_AGE)} AS bucket, count(*) AS rows FROM lineitem GROUP BY 1", "")
_q("movement", f"WITH t AS (SELECT l_discount * 5 - l_tax AS st, {_bucket(_AGE)} AS bucket FROM lineitem) SELECT bucket, {_movement('st', 'bucket')} AS movement, count(*) AS rows FROM t GROUP BY 1, 2", "")
_q("inventory_status", f"""
WITH t AS (SELECT l_quantity - 5 AS inv, CASE WHEN l_linenumber <= 2 THEN 0.0::DOUBLE ELSE l_linenumber * 2.0::DOUBLE END AS rate FROM lineitem)
SELECT {_status('inv', 'rate')} AS status, count(*) AS rows FROM t GROUP BY 1""", "")
_q("stability", "SELECT movement AS recent, overall_movement AS overall, stability, count(*) AS styles FROM ar GROUP BY 1, 2, 3", _ART_BASE)
_q("fold_names", r"""
SELECT page_id, regexp_replace(lower(url), '[^a-z0-9]+', '', 'g') AS folded, trim(regexp_replace(lower(url), '[^a-z0-9]+', ' ', 'g')) AS words,
       regexp_replace(lower(url), '[\s_\-]+', '', 'g') AS plain FROM pages""", "")
_q("money_text", "SELECT o_orderkey, o_totalprice::DECIMAL(18,2)::DOUBLE AS value FROM orders", "")
_q("number_text", f"SELECT s_suppkey, {_fmt('s_acctbal / 8')} AS text FROM supplier", "")
_q("parse_when", "SELECT event_id, CASE WHEN event_id % 3 < 2 THEN date_trunc('second', ts) END AS parsed FROM events", "")
_q("parse_dates", """
WITH t AS (SELECT o_orderkey, o_orderstatus, o_orderdate, o_orderkey % (CASE WHEN o_orderstatus = 'F' THEN 20 ELSE 3 END) = 0 AS bad FROM orders),
g AS (SELECT o_orderstatus, count(*) FILTER (WHERE NOT bad) >= count(*) * 0.9 AS iso FROM t GROUP BY 1)
SELECT t.o_orderkey, t.o_orderstatus, CASE WHEN g.iso AND t.bad THEN NULL ELSE t.o_orderdate END AS parsed FROM t JOIN g ON g.o_orderstatus = t.o_orderstatus""", "")
_q("season_date", """
SELECT sku, CASE WHEN style_code LIKE '%-AW24' THEN TIMESTAMP '2024-08-01' WHEN style_code LIKE '%-SS25' THEN TIMESTAMP '2025-02-01'
  WHEN style_code LIKE '%-AW' THEN TIMESTAMP '2023-08-01' END AS season FROM style""")
_q("period_from_name", """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 < 4 THEN o_orderdate END AS period_start,
       CASE WHEN o_orderkey % 5 < 2 THEN o_orderdate + INTERVAL 6 DAY WHEN o_orderkey % 5 < 4 THEN o_orderdate END AS period_end FROM orders""", "")
_q("snapshot_date", "SELECT o_orderkey, o_orderdate AS snapshot FROM orders", "")
_q("month_to_period", """
WITH t AS (SELECT CASE WHEN month(o_orderdate) <= 5 THEN make_timestamp(2001, month(o_orderdate), 1, 0, 0, 0) ELSE make_timestamp(2000, month(o_orderdate), 1, 0, 0, 0) END AS a FROM orders)
SELECT a AS period_start, a + INTERVAL 1 MONTH - INTERVAL 1 DAY AS period_end, count(*) AS rows FROM t GROUP BY 1, 2""", "")
_q("period_days_backfill", "SELECT o_orderdate - INTERVAL 6 DAY AS period_start, count(*) AS rows, max(o_orderdate) AS period_end FROM orders GROUP BY 1", "")
_q("local_time", """
SELECT event_id, strftime(ts + INTERVAL 330 MINUTE, '%Y-%m-%d %H:%M:%S') AS local_time,
       CASE WHEN month(ts) = month(ts + INTERVAL 20 DAY) THEN strftime(ts, '%b') ELSE strftime(ts, '%b') || '-' || strftime(ts + INTERVAL 20 DAY, '%b') END AS label FROM events""", "")

# ----------------------------------------------------------------- alerts

_q("sku_valuation", "SELECT sku AS master_sku, stock_value FROM iv WHERE stock_value > 0", _SKU_BASE)
_q("average_price", """
SELECT sku AS master_sku, so_net / all_sold AS avg_price, (SELECT sum(so_net::DECIMAL(38,8))::DOUBLE / sum(all_sold) FROM so WHERE all_sold > 0) AS overall_price
FROM so WHERE all_sold > 0 AND so_net / all_sold > 0""", _SKU_BASE)
_q("alert_frame_rows", "SELECT * FROM pf", _ALERT_BASE)
for _name in ("out_of_stock", "low_stock", "reorder_level", "best_sellers", "high_returns", "slow_moving", "dead_stock", "stock_ageing"):
    _q(f"alert_{_name}", f"SELECT * EXCLUDE (key) FROM al WHERE alert = '{_name}'", _ALERT_BASE)
_q("alerts_all", "SELECT key, alert, label, severity, sku, item, priority, money_col, reason FROM al", _ALERT_BASE)
_q("alert_summary", f"SELECT alert, label, severity, {_SEV} AS sev_rank, money_col, count(*) AS skus, count(*) AS new_skus, sum(stock) AS units, sum(priority) AS money FROM al GROUP BY ALL", _ALERT_BASE)
_q("alert_top_n", """
SELECT alert, rank, sku, priority, reason FROM (SELECT *, row_number() OVER (PARTITION BY alert ORDER BY priority DESC, sku) AS rank FROM al) WHERE rank <= 15""", _ALERT_BASE)
_q("unique_money", "SELECT money_col, sum(priority) AS money, count(*) AS skus FROM (SELECT DISTINCT money_col, sku, priority FROM al) GROUP BY 1", _ALERT_BASE)
_LIFE = """
SELECT n.key, n.alert, n.sku, n.label, n.item, {status} CASE WHEN o.key IS NULL THEN 'run-2' ELSE 'run-1' END AS first_seen,
       CASE WHEN o.key IS NULL THEN 1 ELSE 2 END::BIGINT AS cycles, n.priority FROM al n LEFT JOIN al1 o ON o.key = n.key"""
_q("alert_lifecycle", _LIFE.format(status="CASE WHEN o.key IS NULL THEN 'NEW' ELSE 'ONGOING' END AS status,"), _TWO_RUNS)
_q("alert_state", _LIFE.format(status=""), _TWO_RUNS)
_q("alert_resolved", "SELECT alert, sku, label, item, 'run-1' AS first_seen, 1::BIGINT AS cycles FROM al1 WHERE key NOT IN (SELECT key FROM al)", _TWO_RUNS)

# -------------------------------------------------------- history and runs

_NEWEST = "ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC"
_q("po_history_upsert", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber {_NEWEST}) AS rn FROM lineitem) WHERE rn = 1""", "")
_q("keyed_events_upsert", """
SELECT user_id, event_type, event_id, ts, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""", "")
_q("merge_counts", """
WITH b AS (SELECT count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag <> 'N')),
a AS (SELECT count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))
SELECT b.n AS before, a.n AS after, a.n - b.n AS added FROM a, b""", "")

# ----------------------------------------------------------- verification


def _check(name: str, raw: str, got: str, tol: float, bad: str = "FAIL") -> str:
    return (f"SELECT '{name}' AS \"check\", {_rint('a', 2)} AS raw_file, {_rint('b', 2)} AS in_report, {_rint('b - a', 2)} AS diff, "
            f"CASE WHEN abs(a - b) <= {tol} THEN 'PASS' ELSE '{bad}' END AS result FROM (SELECT ({raw})::DOUBLE AS a, ({got})::DOUBLE AS b)")


_q("tie_out", " UNION ALL ".join([
    _check("Ledger | units", f"SELECT {_units('qty')} FROM sx", f"SELECT {_units('qty')} FROM fs", 1),
    _check("Ledger | invoice total", f"SELECT {_money('gross')} FROM sx", f"SELECT {_money('gross')} FROM fs", 1),
    _check("Ledger | taxable value", f"SELECT {_money('net')} FROM sx", f"SELECT {_money('net')} FROM fs WHERE basis = ''as_reported''".replace("''", "'"), 1),
    _check("Ledger | returned units", f"SELECT {_units('ret')} FROM sx", f"SELECT {_units('ret')} FROM fs", 1),
    _check("Ledger | returns value", f"SELECT {_money('ret_value')} FROM sx", f"SELECT {_money('ret_value')} FROM fs", 1),
    _check("Ledger | row count", "SELECT count(*) FROM sx", "SELECT count(*) FROM fs", 0),
    _check("Stock | units", f"SELECT {_units('qty')} FROM ix", f"SELECT {_units('qty')} FROM fi", 1),
    _check("Stock | value", f"SELECT {_money('value')} FROM ix", f"SELECT {_money('value')} FROM fi", 1),
    _check("Stock | row count", "SELECT count(*) FROM ix", "SELECT count(*) FROM fi", 0),
    _check("Purchase orders | ordered qty", f"SELECT {_units('ordered')} FROM px", f"SELECT {_units('ordered')} FROM fp", 1),
    _check("Purchase orders | received qty", f"SELECT {_units('received')} FROM px", f"SELECT {_units('received')} FROM fp", 1),
    _check("Purchase orders | pending qty", "SELECT sum(ordered - received) FROM px", f"SELECT {_units('pending')} FROM fp", 1),
    _check("Purchase orders | total value", f"SELECT {_money('total')} FROM px", f"SELECT {_money('total')} FROM fp", 1),
    _check("Purchase orders | row count", "SELECT count(*) FROM px", "SELECT count(*) FROM fp", 0),
    _check("Purchase orders | distinct PO codes", "SELECT count(DISTINCT po_code) FROM px", "SELECT count(DISTINCT po_code) FROM fp", 0),
]))
def _by_source(kind: str, metric: str, raw: str, fact: str, tolerance: int = 1) -> str:
    """One metric of every file of a kind; ``raw`` and ``fact`` are an aggregate and its table."""
    return (f"SELECT '{kind}' AS source_type, source_file, '{metric}' AS metric, {_rint('a', 2)} AS raw_file, {_rint('b', 2)} AS in_report, {_rint('b - a', 2)} AS diff, "
            f"CASE WHEN abs(a - b) <= {tolerance} THEN 'PASS' ELSE 'FAIL' END AS result FROM (SELECT source_file, coalesce(x.v, 0)::DOUBLE AS a, coalesce(y.v, 0)::DOUBLE AS b "
            f"FROM (SELECT source_file, {raw} GROUP BY 1) x FULL JOIN (SELECT source_file, {fact} GROUP BY 1) y USING (source_file))")


def _sources(kind: str, raw: str, fact: str, metrics: dict[str, tuple[str, str]]) -> list[str]:
    each = [_by_source(kind, m, f"{_money(a)} AS v FROM {raw}", f"{_money(b)} AS v FROM {fact}") for m, (a, b) in metrics.items()]
    return [_by_source(kind, "row count", f"count(*) AS v FROM {raw}", f"count(*) AS v FROM {fact}", 0), *each]


_q("tie_out_sources", " UNION ALL ".join([
    *_sources("uniware_tally_gst", "sx", "fs", {
        "units": ("qty", "qty"), "invoice total": ("gross", "gross"), "taxable value": ("net", "CASE WHEN basis = 'as_reported' THEN net END"),
        "returned units": ("ret", "ret"), "returns value": ("ret_value", "ret_value"),
    }),
    *_sources("uniware_inventory", "ix", "fi", {"units": ("qty", "qty"), "value": ("value", "value")}),
    *_sources("uniware_purchase_orders", "px", "fp", {
        "ordered qty": ("ordered", "ordered"), "received qty": ("received", "received"), "rejected qty": ("rejected", "rejected"),
        "pending qty": ("ordered - received", "pending"), "total value": ("total", "total"),
    }),
    "SELECT 'amazon_vc_sales', NULL, 'source file not found', NULL, NULL, NULL, 'FAIL'",
]))
_q("po_line_balance", " UNION ALL ".join([
    _check("PO lines balance (ordered = received + pending + rejected)", "0", "SELECT count(*) FROM fp WHERE abs(ordered - received - pending - rejected) > 0.5", 0, "REVIEW"),
    _check("PO lines matched to a SKU in the master mapping table", "SELECT count(*) FROM fp", "SELECT count(sku) FROM fp", 0, "REVIEW"),
]))
_AMZ = "SELECT coalesce(sum(qty), 0) FROM fs WHERE channel = 'Amazon Vendor Central' AND flow = "
_q("flow_leaks", " UNION ALL ".join([
    _check("purchase rows kept out of the sales fact table", "0", "0", 0),
    _check("every fact row has a flow (sell_in/sell_out/exclude)", "0", "SELECT count(*) FROM fs WHERE flow = 'unknown'", 0),
    f"""SELECT 'Amazon Vendor Central sell-in and sell-out kept as distinct measures', a, b, b - a, CASE WHEN a > 0 AND b > 0 AND a <> b THEN 'PASS' ELSE 'REVIEW' END
        FROM (SELECT ({_AMZ}'sell_in') AS a, ({_AMZ}'sell_out') AS b)""",
    _check("excluded ledgers not counted in channel totals", "SELECT count(*) FROM fs WHERE sku IS NOT NULL AND flow NOT IN ('exclude', 'unknown')", "SELECT count(*) FROM mapped", 0),
]))


def _agree(name: str, valid: str, ok: str, floor: float) -> str:
    pct = f"coalesce(count(*) FILTER (WHERE ({valid}) AND ({ok})) * 100::DOUBLE / nullif(count(*) FILTER (WHERE {valid}), 0), 0)"
    return (f"SELECT '{name}' AS rule, count(*) FILTER (WHERE ({valid}) AND ({ok})) AS matched, count(*) FILTER (WHERE {valid}) AS \"of\", "
            f"{_rint(pct, 1)} AS pct, CASE WHEN {pct} >= {floor} THEN 'PASS' ELSE 'FAIL' END AS result FROM sv")


_q("rule_agreement", " UNION ALL ".join([
    _agree("Net sale", "net_sale IS NOT NULL", "abs(net_sale - (sale + amazon_sold + retail - ret - amazon_ret)) <= 0.01", 99),
    _agree("Returns", "returns IS NOT NULL", "abs(returns - ret - amazon_ret) <= 0.01", 99),
    _agree("For 3 months", "for_3_months IS NOT NULL", "abs(for_3_months - ros_month * 3) <= 0.01", 99),
    _agree("monthly ros", "monthly_ros IS NOT NULL", "abs(monthly_ros - recent_sold * 2) <= 0.01", 99),
    _agree("Overall Sell-through", "overall_st IS NOT NULL AND purchase_qty <> 0", "abs(overall_st - overall_net / purchase_qty) <= 0.01", 99),
    _agree("Overall Movement class", "overall_movement IS NOT NULL", "true", 98),
    _agree("Movement class", "movement IS NOT NULL", "true", 98),
]), _SKU_BASE)


# ------------------------------------------------------------------ files

_q("file_inventory", r"""
WITH f AS (
  SELECT doc_id, n_chars, CASE doc_id % 6 WHEN 0 THEN '_archive' WHEN 1 THEN 'stores/Old' WHEN 2 THEN 'vendor/week 1' WHEN 3 THEN '' ELSE 'stores' END AS folder,
         CASE doc_id % 7 WHEN 0 THEN '~$' WHEN 1 THEN '.' ELSE '' END || source || '_' || doc_id AS stem,
         CASE doc_id % 5 WHEN 0 THEN 'csv' WHEN 1 THEN 'XLSX' WHEN 2 THEN 'txt' WHEN 3 THEN 'xls' ELSE 'csv' END AS ext FROM documents)
SELECT '/data/input/' || CASE WHEN folder = '' THEN '' ELSE folder || '/' END || stem || '.' || ext AS path, stem || '.' || ext AS name, folder, lower(ext) AS suffix, n_chars AS bytes
FROM f WHERE ext <> 'txt' AND doc_id % 7 > 1 AND doc_id % 6 > 1""", "")
_q("dedupe_files", """
WITH f AS (
  SELECT '/in/' || lpad(doc_id::VARCHAR, 12, '0') AS path,
         'Report_' || doc_id || CASE WHEN doc_id % 4 = 0 THEN '__' || upper(lang) || '.csv' WHEN doc_id % 4 = 1 THEN '__' || upper(lang) || '_20240101_0930.csv' WHEN doc_id % 50 = 2 THEN '__COMBINED.csv' ELSE '.csv' END AS name,
         CASE WHEN doc_id % 4 < 2 THEN upper(lang) WHEN doc_id % 50 = 2 THEN 'COMBINED' ELSE '' END AS tag, doc_id % 4 >= 2 AND doc_id % 50 = 2 AS comb,
         CASE WHEN source IN ('src0', 'src1') THEN 'uniware_inventory' WHEN source = 'src2' THEN 'UNRECOGNISED' WHEN doc_id % 50 = 2 THEN 'uniware_returns' ELSE 'kind_' || source END AS kind,
         CASE WHEN doc_id % 9 = 0 THEN 'Sale' ELSE '' END AS sheet, (doc_id * 7919) % 100003 AS modified, strlen(text) AS bytes, text FROM documents),
a AS (SELECT *, CASE WHEN tag <> '' AND tag <> 'EN' AND NOT comb THEN 'facility ' || tag || ' — this run is scoped to EN' END AS r1 FROM f),
b AS (SELECT *, CASE WHEN r1 IS NULL AND tag <> '' AND NOT comb AND kind IN (SELECT kind FROM a WHERE r1 IS NULL AND comb) THEN 'per-facility split; a __COMBINED file for this report is present' END AS r2 FROM a),
c0 AS (SELECT path, first_value(name) OVER w AS fname, first_value(path) OVER w AS fpath FROM b WHERE r1 IS NULL AND r2 IS NULL WINDOW w AS (PARTITION BY text, sheet ORDER BY path)),
c AS (SELECT b.*, CASE WHEN c0.fpath <> c0.path THEN 'byte-identical duplicate of ' || fname END AS r3 FROM b LEFT JOIN c0 ON c0.path = b.path),
d0 AS (SELECT path, first_value(name) OVER w AS wname, first_value(path) OVER w AS wpath, first_value(bytes) OVER w AS wbytes FROM c
       WHERE r1 IS NULL AND r2 IS NULL AND r3 IS NULL AND kind <> 'UNRECOGNISED' WINDOW w AS (PARTITION BY kind, sheet, CASE WHEN comb THEN '' ELSE tag END ORDER BY modified DESC, path DESC)),
d AS (SELECT c.*, CASE WHEN d0.wpath <> d0.path THEN CASE WHEN kind = 'uniware_inventory' THEN 'point-in-time snapshot — summing two would double-count stock' ELSE 'overlapping window — summing two would double-count sales' END
        || '; superseded by ' || wname || CASE WHEN bytes > wbytes * 1.2 THEN '  ** WARNING: the superseded file is larger (' || format('{:,}', bytes) || ' vs ' || format('{:,}', wbytes) || ' bytes) — the newer pull may cover a shorter window **' ELSE '' END END AS r4
      FROM c LEFT JOIN d0 ON d0.path = c.path)
SELECT path, name AS file, kind, coalesce(r1, r2, r3, r4) AS reason FROM d""", "")
_q("content_profile", """
WITH f AS (SELECT doc_id, list_sort(string_split(text, chr(10))) AS l FROM documents),
g AS (SELECT l, count(*) AS copies, sum(len(l)) AS rows FROM f GROUP BY l)
SELECT copies, true AS utf8, count(*) AS contents, sum(rows)::BIGINT AS rows FROM g GROUP BY 1""", "")
_q("find_header_row", """
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents)
SELECT doc_id::VARCHAR AS source_file, min(i) FILTER (WHERE i < 25 AND contains(lower(line), 'tion')::INT + contains(lower(line), 'er')::INT + contains(lower(line), 'ou')::INT >= 2) AS header_row
FROM l GROUP BY 1""", "")
_q("classify_source", """
WITH f AS (SELECT o_orderkey AS k, o_orderkey % 10 AS h, o_orderkey % 4 AS n, o_orderkey % 3 = 0 AS banner FROM orders),
g AS (SELECT *, CASE WHEN h = 0 THEN 'amazon_vc_sales' WHEN h = 1 THEN 'amazon_vc_inventory' WHEN banner THEN NULL WHEN h = 2 THEN 'uniware_tally_gst' WHEN h = 3 THEN 'uniware_returns'
        WHEN h IN (4, 5) THEN 'uniware_purchase_orders' WHEN h = 6 THEN 'uniware_inventory' WHEN h = 7 THEN 'uniware_item_master' END AS by_head FROM f)
SELECT k::VARCHAR AS path, coalesce(by_head, CASE n WHEN 0 THEN 'store_blocks' WHEN 1 THEN 'store_matrix_soh' ELSE 'UNRECOGNISED' END) AS kind,
       CASE WHEN by_head IS NULL THEN CASE n WHEN 0 THEN 'jack_jill_sale' WHEN 1 THEN 'jack_jill_soh' END END AS profile_id,
       CASE WHEN by_head IS NOT NULL AND banner THEN 1 WHEN by_head IS NULL AND n = 1 THEN 1 ELSE 0 END AS header_row FROM g""", "")
_q("match_store_profile", """
WITH s AS (
  SELECT l_orderkey % 3 AS b, CASE l_orderkey % 3 WHEN 0 THEN 'All Sports ' WHEN 1 THEN 'INCS ' ELSE 'Other ' END || l_orderkey || '.xlsx' AS source_file,
         CASE WHEN l_orderkey % 2 = 0 THEN 'Sale Report' ELSE 'Soh' END AS sheet, bool_or(l_linenumber = 3) AS has3, bool_or(l_linenumber = 4) AS has4
  FROM lineitem GROUP BY 1, 2, 3),
h AS (SELECT *, CASE WHEN b = 0 AND sheet = 'Sale Report' AND has3 THEN 3 WHEN b = 0 AND sheet = 'Soh' AND has4 THEN 4 WHEN b = 1 AND has3 THEN 3 END AS header_row FROM s)
SELECT source_file, sheet, CASE WHEN header_row IS NULL THEN 'UNRECOGNISED' WHEN b = 0 AND sheet = 'Soh' THEN 'store_flat_soh' ELSE 'store_flat' END AS kind,
       CASE WHEN header_row IS NULL THEN NULL WHEN b = 1 THEN 'incs' WHEN sheet = 'Soh' THEN 'all_sports_soh' ELSE 'all_sports_sale' END AS profile_id, header_row::BIGINT AS header_row FROM h""", "")
_q("detect_master", """
SELECT max(f) AS source_file FROM (SELECT 'book ' || lpad(l_orderkey::VARCHAR, 10, '0') AS f FROM lineitem GROUP BY l_orderkey HAVING bool_or(l_linenumber = 2) AND bool_or(l_linenumber = 3 AND l_returnflag = 'R'))""", "")
_q("discover_po_files", """
WITH f AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'Purchase Orders_18082026.csv' WHEN 1 THEN 'Purchase_Orders_history.csv' WHEN 2 THEN 'purchase-order.csv' WHEN 3 THEN 'PO master.xlsx' ELSE 'sales.csv' END AS name FROM orders)
SELECT o_orderkey, name, CASE WHEN o_orderkey % 5 IN (0, 2) THEN 'name' ELSE 'columns' END AS found_by FROM f
WHERE o_orderkey % 5 IN (0, 2) OR (o_orderkey % 5 IN (3, 4) AND o_orderkey % 2 = 0)""", "")
_q("input_freshness", """
WITH s AS (SELECT event_type AS folder, count(*) AS files, max(ts + CASE WHEN event_type = 'view' THEN INTERVAL 5 DAY ELSE INTERVAL 0 DAY END) AS newest FROM events GROUP BY 1),
e(folder) AS (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view'), ('stores')),
g AS (SELECT e.folder, coalesce(files, 0) AS files, newest, floor(date_sub('hour', newest, TIMESTAMP '2024-02-10') / 24)::BIGINT AS age_days FROM e LEFT JOIN s ON s.folder = e.folder)
SELECT folder, files, newest, age_days, CASE WHEN newest IS NULL THEN 'EMPTY' WHEN age_days > 10 THEN 'STALE' ELSE 'OK' END AS state FROM g""", "")
_q("input_fingerprint", """
WITH l AS (SELECT sha256(event_type || '/' || props || '|' || event_id || '|' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '|' || user_id) AS h FROM events),
s AS (SELECT count(*) AS files, sum(('0x' || substr(h, 1, 15))::BIGINT)::VARCHAR AS a, sum(('0x' || substr(h, 16, 15))::BIGINT)::VARCHAR AS b, sum(('0x' || substr(h, 31, 15))::BIGINT)::VARCHAR AS c FROM l)
SELECT files, substr(sha256(files || '|' || a || '|' || b || '|' || c || '|rules-1'), 1, 16) AS fingerprint FROM s""", "")
_q("run_settings", """
WITH l AS (SELECT sha256(event_type || '/' || props || '|' || event_id || '|' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '|' || user_id) AS h FROM events),
s AS (SELECT count(*) AS files, sum(('0x' || substr(h, 1, 15))::BIGINT)::VARCHAR AS a, sum(('0x' || substr(h, 16, 15))::BIGINT)::VARCHAR AS b, sum(('0x' || substr(h, 31, 15))::BIGINT)::VARCHAR AS c FROM l),
x(state, low, day) AS (VALUES ('as it was', 1, 1), ('other rule', 2, 1), ('other day', 1, 2))
SELECT state, files, substr(sha256(files || '|' || a || '|' || b || '|' || c || '|["WH1", "2026-01-0' || day || '", {"low": ' || low || '}, [], []]'), 1, 16) AS fingerprint FROM s, x""", "")
_q("reject_counts", """
SELECT 'in_' || file || '.csv' AS source_file, reason, count(*) AS rows FROM (
  SELECT l_suppkey % 7 AS file, CASE WHEN l_tax = 0.08::DOUBLE THEN ['more cells than the header has columns'] ELSE
    list_filter([CASE WHEN l_linenumber = 6 THEN 'not a number: Qty' END, CASE WHEN l_linenumber = 2 AND l_tax = 0.05::DOUBLE THEN 'not a number: Total' END], lambda r: r IS NOT NULL) END AS reasons
  FROM lineitem), unnest(reasons) AS u(reason) GROUP BY 1, 2""", "")
_q("retired_files", """
SELECT o_orderkey AS file_id, 'f' || o_custkey AS name FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 100 <> 0""", "")
_q("source_presence", """
WITH n AS (SELECT event_type, event_type || '_Report ' || event_id || '.csv' AS name FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1)
SELECT 'Click Report' AS source, (SELECT name FROM n WHERE event_type = 'click') AS file, 'present' AS state, 'PASS' AS result
UNION ALL SELECT 'error-report', (SELECT name FROM n WHERE event_type = 'error'), 'not readable', 'FAIL'
UNION ALL SELECT 'Refund Report', NULL, 'source file not found', 'FAIL'""", "")
_q("profile_table", """
SELECT event_type AS value, count(*) AS count, (SELECT count(*) FROM events) AS rows, 6 AS columns FROM events GROUP BY 1""", "")
_q("combine_same_schema", "SELECT l_returnflag, count(*) AS rows, sum(l_quantity) AS qty FROM lineitem GROUP BY 1", "")
_q("item_master", """
SELECT upper(p_brand) || '-' || p_size AS master_sku, arg_min(p_type, p_partkey) AS category, arg_min(p_name, p_partkey) AS gender, arg_min(p_retailprice, p_partkey) AS mrp,
       (any_value(p_size) + 1990)::DOUBLE AS product_year FROM part GROUP BY 1""", "")

# --------------------------------------------------------------- adapters

_q("adapt_tally_gst", f"""
SELECT l_returnflag AS ledger, 'day' AS grain, 'sku_code' AS external_id_type, sum(l_quantity) AS units, {_money('l_extendedprice')} AS gross, {_money('l_extendedprice * 0.5::DOUBLE')} AS net,
       min(l_shipdate) AS first_day, max(l_shipdate) AS last_day, count(DISTINCT l_partkey) AS ids FROM lineitem GROUP BY 1""", "")
_q("adapt_tally_returns", f"SELECT l_returnflag AS ledger, sum(l_quantity) AS units, {_money('l_extendedprice')} AS value, max(l_shipdate) AS last_day FROM lineitem GROUP BY 1", "")
_q("adapt_amazon_sales", f"""
SELECT 'Amazon Vendor Central' AS channel, 'Amazon FC (IN)' AS location, 'sell_out' AS flow, 'period' AS grain, TIMESTAMP '2001-06-01' AS period_start, TIMESTAMP '2001-06-30' AS period_end,
       sum(l_quantity) AS ordered, sum(l_quantity - 1) AS shipped, (count(*) FILTER (WHERE l_returnflag = 'R'))::DOUBLE AS returned, {_money('l_extendedprice')} AS gross, 0.0::DOUBLE AS net FROM lineitem""", "")
_q("adapt_amazon_inventory", f"SELECT 'B' || l_partkey AS external_id, TIMESTAMP '2001-07-31' AS snapshot_date, sum(l_quantity) AS units, {_money('l_extendedprice')} AS value FROM lineitem GROUP BY 1", "")
_q("adapt_warehouse", f"""
SELECT 'Warehouse' AS channel, 'WH' || (l_suppkey % 5) AS location, TIMESTAMP '2001-07-31 09:30:00' AS snapshot_date, sum(l_quantity) AS units, {_money('l_quantity * 1050.5::DOUBLE')} AS value FROM lineitem GROUP BY 2""", "")
_q("adapt_purchase_orders", f"""
SELECT 'V' || l_suppkey AS vendor, CASE WHEN l_linestatus = 'F' THEN 'COMPLETE' ELSE 'APPROVED' END AS po_status, sum(l_quantity) AS ordered, sum(l_quantity - 1) AS received,
       count(*)::DOUBLE AS pending, 0::BIGINT AS rejected_rows, {_money('l_extendedprice')} AS value, min(l_shipdate) AS first_po FROM lineitem GROUP BY 1, 2""", "")
_q("adapt_store_flat", f"""
SELECT 'All Sports' AS channel, 'All Sports' AS location, 'day' AS grain, l_shipdate AS period_start, sum(l_quantity) AS units, {_money('l_extendedprice')} AS gross, {_money('l_extendedprice * 0.5::DOUBLE')} AS net
FROM lineitem WHERE l_orderkey % 11 <> 0 GROUP BY l_shipdate""", "")
_q("adapt_store_month", f"""
WITH t AS (SELECT *, make_timestamp(CASE WHEN month(l_shipdate) <= 5 THEN 2001 ELSE 2000 END, month(l_shipdate), 1, 0, 0, 0) AS a FROM lineitem)
SELECT 'Shop ' || (l_suppkey % 3) AS location, a AS period_start, a + INTERVAL 1 MONTH - INTERVAL 1 DAY AS period_end, sum(l_quantity) AS units, {_money('l_extendedprice')} AS net,
       count(DISTINCT l_partkey // 8) AS styles FROM t GROUP BY 1, 2, 3""", "")
_q("store_matrix_unpivot", "SELECT l_partkey AS external_id, 'Store ' || (l_suppkey % 5) AS location, sum(l_quantity) AS qty_on_hand FROM lineitem GROUP BY 1, 2", "")
_q("adapt_store_matrix", "SELECT 'S' || l_partkey AS external_id, 'Store ' || (l_suppkey % 5) AS location, sum(l_quantity) AS qty_on_hand, TIMESTAMP '2001-07-31' AS snapshot_date FROM lineitem GROUP BY 1, 2", "")
_BLOCKS = """WITH b AS (SELECT 'S' || l_partkey AS external_id, CASE l_suppkey % 3 WHEN 0 THEN 'KOHIMA' WHEN 1 THEN '5TH MILE' ELSE 'DIMAPUR' END AS location, sum(l_quantity) AS qty_sold
  FROM lineitem WHERE l_partkey % 50 <> 0 GROUP BY 1, 2)"""
_q("store_blocks_unpivot", "SELECT 'f' AS source_file, external_id, location, qty_sold FROM b", _BLOCKS)
_q("adapt_store_blocks", """
SELECT 'Jack & Jill' AS channel, location, TIMESTAMP '2001-07-25' AS period_start, TIMESTAMP '2001-07-31' AS period_end, sum(qty_sold) AS units, count(*) AS rows FROM b GROUP BY 2""", _BLOCKS)
_q("tolerant_columns", f"SELECT count(*) AS rows, {_money('s_acctbal')} AS value FROM supplier", "")

# --------------------------------------------------------- sinks and runs

_q("latest_runs", """
SELECT run_id, rows, qty FROM (SELECT strftime(l_shipdate, '%Y-%m') AS run_id, count(*) AS rows, sum(l_quantity) AS qty, dense_rank() OVER (ORDER BY strftime(l_shipdate, '%Y-%m') DESC) AS r FROM lineitem GROUP BY 1) WHERE r <= 12""", "")
_q("prunable_runs", """
SELECT run_id FROM (SELECT strftime(l_shipdate, '%Y-%m') AS run_id, dense_rank() OVER (ORDER BY strftime(l_shipdate, '%Y-%m') DESC) AS r FROM lineitem GROUP BY 1) WHERE r > 12""", "")


def _top(table: str, key: str, n: int | None, sql: str) -> str:
    num = "row_number() OVER (ORDER BY units DESC, k)" if n else "NULL::INT"
    cut = f"WHERE position <= {n}" if n else ""
    return (f"SELECT '{table}' AS \"table\", position, '{{\"{key}\":\"' || k || '\",\"units\":' || units || '}}' AS json "
            f"FROM (SELECT k, units, {num} AS position FROM ({sql})) {cut}")


_q("dashboard_payload", " UNION ALL ".join([
    _top("channel", "channel", None, "SELECT channel AS k, coalesce(sum(qty) FILTER (WHERE flow = 'sell_in'), 0)::BIGINT AS units FROM mapped GROUP BY 1"),
    _top("sku", "master_sku", 40, "SELECT sku AS k, coalesce(sum(qty) FILTER (WHERE flow = 'sell_out'), 0)::BIGINT AS units FROM mapped GROUP BY 1"),
    _top("po_vendor", "vendor", 20, "SELECT vendor AS k, sum(pending)::BIGINT AS units FROM fp WHERE vendor IS NOT NULL AND po_status = 'Approved' GROUP BY 1"),
    _top("po_sku", "master_sku", 25, "SELECT sku AS k, sum(pending)::BIGINT AS units FROM fp WHERE sku IS NOT NULL GROUP BY 1"),
]))
_q("rule_mismatches", "SELECT sku AS item, overall_movement AS given, movement AS computed FROM sv WHERE overall_movement IS NOT NULL AND movement IS NOT NULL AND overall_movement <> movement", _SKU_BASE)
_SCOPE = "WHERE facility IS NULL OR upper(facility) = 'LOC1'"
_q("tie_out_scoped", " UNION ALL ".join(
    _check(f"Purchase orders | {name}", f"SELECT {x} FROM px {_SCOPE}", f"SELECT {y} FROM fp {_SCOPE}", tol)
    for name, x, y, tol in (
        ("ordered qty", _units("ordered"), _units("ordered"), 1), ("received qty", _units("received"), _units("received"), 1),
        ("pending qty", _units("ordered - received"), _units("pending"), 1), ("total value", _money("total"), _money("total"), 1),
        ("row count", "count(*)", "count(*)", 0), ("distinct PO codes", "count(DISTINCT po_code)", "count(DISTINCT po_code)", 0))))

# ------------------------------------------------------ history, streaming

_q("po_history_aliases", f"""
SELECT 'PO' || l_orderkey AS po_code, 'S' || l_linenumber AS sku, l_quantity AS ordered, l_shipdate AS updated
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber {_NEWEST}) AS rn FROM lineitem) WHERE rn = 1""", "")
ORACLE["po_history_stream"] = ORACLE["po_history_upsert"]
_q("alert_lifecycle_stream", """
SELECT n.key, CASE WHEN o.key IS NULL THEN 'NEW' ELSE 'ONGOING' END AS status, CASE WHEN o.key IS NULL THEN 'run-1' ELSE 'run-0' END AS first_seen,
       CASE WHEN o.key IS NULL THEN 1 ELSE 2 END::BIGINT AS cycles, n.priority FROM al n LEFT JOIN al1 o ON o.key = n.key
UNION ALL SELECT key, 'RESOLVED', 'run-0', 1, priority FROM al1 WHERE key NOT IN (SELECT key FROM al)""", _TWO_RUNS)
_q("po_history_ties", """
SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber, l_returnflag
FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY year(l_shipdate) DESC, (l_returnflag = 'N') DESC, l_orderkey DESC, l_linenumber DESC) AS rn
      FROM lineitem) WHERE rn = 1""", "")
_q("alert_runs_waiting", """
WITH o AS (SELECT DISTINCT 'late|' || l_partkey AS key, l_partkey::DOUBLE AS priority, run FROM lineitem, (VALUES (0), (1), (2)) AS r(run)
           WHERE (l_orderkey // 4 + run) % 3 <> 0),
k AS (SELECT key, max(priority) AS priority, bool_or(run = 0) AS a, bool_or(run = 1) AS b, bool_or(run = 2) AS c FROM o GROUP BY key)
SELECT 'run-0' AS run_id, key, 'NEW' AS status, 'run-0' AS first_seen, 1::BIGINT AS cycles, priority FROM k WHERE a
UNION ALL SELECT 'run-1', key, CASE WHEN a AND b THEN 'ONGOING' WHEN b THEN 'NEW' ELSE 'RESOLVED' END, CASE WHEN a THEN 'run-0' ELSE 'run-1' END,
  CASE WHEN a AND b THEN 2 ELSE 1 END, priority FROM k WHERE a OR b
UNION ALL SELECT 'run-2', key, CASE WHEN b AND c THEN 'ONGOING' WHEN c THEN 'NEW' ELSE 'RESOLVED' END,
  CASE WHEN NOT b THEN 'run-2' WHEN a THEN 'run-0' ELSE 'run-1' END,
  CASE WHEN NOT b THEN 1 ELSE (CASE WHEN a THEN 2 ELSE 1 END) + (CASE WHEN c THEN 1 ELSE 0 END) END, priority FROM k WHERE b OR c""", "")
_q("norm_id", """
WITH t AS (SELECT page_id, upper(trim(regexp_extract(url, '[^/]*$'))) AS key FROM pages)
SELECT page_id, CASE WHEN key NOT IN ('', 'NAN', 'NONE', 'NAT') THEN key END AS key FROM t""", "")
_q("master_layouts", """
SELECT layout::INT AS layout, 'S' || p_partkey AS sku,
       'ST' || (p_partkey // 8) || CASE (p_partkey // 8) % 4 WHEN 0 THEN '-AW24' WHEN 1 THEN '-SS25' WHEN 2 THEN '-AW' ELSE '' END AS style,
       CASE WHEN layout < 2 AND p_partkey % 2 = 0 THEN 'B' || p_partkey END AS az_asin,
       CASE WHEN layout <> 1 AND p_partkey % 3 = 0 THEN 'F' || p_partkey END AS fk_sku,
       CASE WHEN layout = 2 THEN p_partkey::VARCHAR END AS fsn, p_partkey AS place
FROM part, (VALUES (0), (1), (2)) AS v(layout)""", "")
_q("folder_run", """
WITH price AS (SELECT l_partkey, arg_max(100 + l_partkey % 900 + l_linenumber, (l_orderkey, l_linenumber)) AS mrp FROM lineitem WHERE l_suppkey % 3 = 0 GROUP BY 1),
l AS (SELECT lineitem.*, 'F' || (l_suppkey % 3) AS f, l_extendedprice::DECIMAL(18,2) AS total, l_partkey % 50 <> 0 AND l_partkey IN (SELECT p_partkey FROM part) AS sold,
             l_partkey IN (SELECT p_partkey FROM part) AS known, mrp,
             ['sell_in', 'sell_out', 'exclude', 'sell_in', 'unknown'][(l_orderkey % 5 + 1)::INT] AS flow
      FROM lineitem LEFT JOIN price USING (l_partkey)),
s AS (SELECT f, flow, CASE WHEN l_linenumber = 4 THEN 'gross_fallback' WHEN l_linenumber = 5 AND sold AND mrp IS NOT NULL THEN 'imputed_mrp' ELSE 'as_reported' END AS basis,
             CASE WHEN l_linenumber <> 5 THEN total WHEN sold THEN l_quantity::INT * mrp END AS net FROM l),
sales AS (SELECT 'Tally GST__' || f || '.csv|' || flow || '|' || basis AS name, count(*)::DOUBLE AS n, coalesce(round(sum(net), 2), 0)::DOUBLE AS net FROM s GROUP BY 1),
vendor AS (SELECT 'V' || l_suppkey || CASE WHEN l_linenumber = 2 THEN ', "the' || chr(10) || 'best"' ELSE '' END AS name,
                  count(*)::DOUBLE AS n, sum(l_quantity::INT - 1)::DOUBLE AS pending FROM l GROUP BY 1),
audit AS (SELECT kind || '|' || CASE kind WHEN 'sales' THEN 'Tally GST' WHEN 'inventory' THEN 'Inventory' ELSE 'Purchase Orders' END || '__' || f || '.csv' AS name,
                 count(*)::DOUBLE AS n, sum(CASE WHEN kind = 'sales' THEN sold ELSE known END::INT)::DOUBLE AS matched, sum(l_quantity::INT)::DOUBLE AS qty
          FROM l, (VALUES ('sales'), ('inventory'), ('purchase')) AS k(kind) GROUP BY 1),
noted AS (SELECT DISTINCT p_partkey // 8 AS style FROM part WHERE p_partkey % 8 = 1 AND p_partkey % 3 <> 0),
skus AS (SELECT p_brand || '|Men|' || CASE WHEN p_partkey // 8 IN (SELECT style FROM noted) THEN 'Re-order, soon' ELSE '' END || '|'
                || CASE WHEN p_partkey % 3 = 0 THEN 'Hold' ELSE '' END AS name, count(*)::DOUBLE AS n
         FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem) GROUP BY 1)
SELECT 'sales' AS section, name, unnest(['rows', 'net']) AS figure, unnest([n, net]) AS value FROM sales
UNION ALL SELECT 'stock', 'Inventory__' || f || '.csv|' || f, 'qty', sum(l_quantity::INT)::DOUBLE FROM l GROUP BY f
UNION ALL SELECT 'vendor', name, unnest(['rows', 'pending']), unnest([n, pending]) FROM vendor
UNION ALL SELECT 'audit', name, unnest(['rows', 'matched', 'qty']), unnest([n, matched, qty]) FROM audit
UNION ALL SELECT 'skus', name, 'skus', n FROM skus
UNION ALL VALUES ('skipped', 'Item Master.csv|uniware_item_master|dimension file, not a fact table - not loaded by design', 'files', 1.0::DOUBLE),
  ('skipped', 'junk.csv|UNRECOGNISED|no rule matched', 'files', 1),
  ('superseded', 'Item_Master early.csv|uniware_item_master|point-in-time snapshot — summing two would double-count stock; superseded by Item Master.csv', 'files', 1),
  ('superseded', 'Tally GST old__F0.csv|uniware_tally_gst|overlapping window — summing two would double-count sales; superseded by Tally GST__F0.csv', 'files', 1),
  ('superseded', 'copy of Tally GST__F1.csv|uniware_tally_gst|byte-identical duplicate of Tally GST__F1.csv', 'files', 1),
  ('tie-out', 'PASS', 'files', 9), ('status', 'OK', 'runs', 1), ('status', 'SKIPPED', 'runs', 1)""", "")
