"""DuckDB SQL for the operators SQL can express."""

from stockweave.llm import licenses as L

#: Weighted fair queueing over all documents; the constants repeat mixing.WEIGHTS, MAX_REPEATS and SEED.
MIX = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         md5('mix-1:' || coalesce(cast(doc_id as varchar), '')) as shuffle
  from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
w as (
  select *, [5, 2, 1][((row_number() over (order by source is null, source) - 1) % 3 + 1)::int]::bigint as weight, source_size * 3 as cap from s),
c as (
  select *, cap * sum(weight) over (order by cap / weight, source is null, source rows between current row and unbounded following)
    <= (sum(source_size) over () - coalesce(sum(cap) over (order by cap / weight, source is null, source rows between unbounded preceding and 1 preceding), 0)) * weight as capped
  from w),
t as (
  select source, source_size, case when capped then cap::double
    else (weight * (sum(source_size) over () - sum(case when capped then cap else 0 end) over ()))::double
         / (sum(case when capped then 0 else weight end) over ())::double end as target
  from c),
q as (
  select d.doc_id, d.size, t.source_size, t.target,
         (sum(d.size) over (partition by d.source order by d.shuffle, d.size rows unbounded preceding))::bigint as upto
  from d join t on d.source is not distinct from t.source),
f as (select size, (k * source_size + upto)::double / target as finish from q, (values (0), (1), (2)) as r(k) where size > 0 and target > 0),
v as (
  select max(finish) as cut from (
    select finish, sum(sum(size)) over (order by finish) as total from f where finish <= 2 group by finish)
  where total <= (select sum(size) from d))
select doc_id, size, source_size, target,
       case when target > 0 then (size * ((upto::double / target <= cut)::int + ((source_size + upto)::double / target <= cut)::int
            + ((2 * source_size + upto)::double / target <= cut)::int))::bigint else 0 end as taken
from q, v
"""

#: Payload groups over all pages; 1000 repeats warc.MIN_BYTES.
WARC = """
with p as (select page_id, coalesce(html, '') as html, strlen(coalesce(html, ''))::bigint as n from pages),
g as (select *, case when n >= 1000 then max(page_id) over (partition by html) end as keeper from p)
select page_id, n as payload_bytes, sha1(html) as payload_digest,
       case when keeper is null or page_id = keeper then 'response' else 'revisit' end as record_type,
       case when page_id <> keeper then keeper end as refers_to
from g
"""



def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _licenses() -> str:
    """The licence scan; the known texts go through the same canonical form in SQL."""
    known = L.TEXTS + [(k, n.format(name)) for k, names in L.NAMES.items() for name in names for n in L.NOTICES]
    values = ", ".join(f"({_quoted(k)}, {_quoted(t)})" for k, t in known)
    # RE2 has no look-ahead, so copyright lines are told line by line.
    low = r"""list_transform(string_split(lower({}), chr(10)), lambda x:
      case when (regexp_matches(x, '^[^\p{{L}}\p{{N}}]*copyright') and not regexp_matches(x, '^[^\p{{L}}\p{{N}}]*copyright[\p{{L}} ]*(holder|owner|notice)'))
             or regexp_matches(x, '^[^\p{{L}}\p{{N}}]*(\(c\)|©|all rights reserved)') then '' else x end)"""
    spelled = r"' ' || replace(regexp_replace(x, '[^\p{L}\p{N}]+', ' ', 'g'), ' ', '  ') || ' '"
    for variant, usual in L.SPELLINGS:
        spelled = f"replace({spelled}, ' {variant.replace(' ', '  ')} ', ' {usual.replace(' ', '  ')} ')"
    lines = lambda text: f"list_transform({low.format(text)}, lambda x: trim(regexp_replace({spelled}, ' +', ' ', 'g')))"
    one = "trim(regexp_replace(array_to_string(l, ' '), ' +', ' ', 'g'))"
    return rf"""
with known as (select sha256({one}) as digest, min(license) as license from (select license, {lines("text")} as l from (values {values}) as v(license, text)) group by 1),
d as (select doc_id, {lines("coalesce(text, '')")} as l from documents),
w as (select doc_id, case when {one} <> '' then sha256({one}) end as canonical_sha256, l from d),
u as (select doc_id, unnest(l) as line from d),
m as (select doc_id, string_agg(distinct license, ' ' order by license) as line_licenses, count(*) as n from u join known on sha256(line) = digest where line <> '' group by doc_id)
select w.doc_id, canonical_sha256, known.license, line_licenses, coalesce(n, 0) as n_license_lines
from w left join known on canonical_sha256 = known.digest left join m on w.doc_id = m.doc_id
"""


#: Phrases of up to five words per language; the constants repeat phrases.MIN_COUNT, MAX_WORDS and TOP.
PHRASES = r"""
with d as (
  select coalesce(lang, 'und') as lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
p as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from d),
g as (select lang, k, unnest(list_transform(generate_series(1, len(w) - k + 1), lambda i: array_to_string(w[i:i + k - 1], ' '))) as phrase
      from p, (values (1), (2), (3), (4), (5)) as s(k) where len(w) >= k),
c as (select lang, k, phrase, count(*)::bigint as f from g group by all),
n as (select lang, sum(f)::bigint as n from c where k = 1 group by lang),
f as (select lang, k, string_split(phrase, ' ') as w, phrase, f from c where f >= 100),
q as (select lang, max(f) as f, phrase from (
        select lang, f, array_to_string(w[1:k - 1], ' ') as phrase from f where k > 2 union all
        select lang, f, array_to_string(w[2:k], ' ') from f where k > 2) group by lang, phrase),
x as (select f.* from f left join q on q.lang = f.lang and q.phrase = f.phrase where k > 1 and (q.f is null or 100 * q.f < 100 * f.f)),
s as (select x.lang, x.phrase, x.f as a, j, l.f as l, r.f as r, n.n, ((1000::hugeint * x.f * n.n) // (l.f::hugeint * r.f))::bigint as score
      from x, generate_series(1, 4) as t(j), f l, f r, n
      where j < x.k and l.lang = x.lang and r.lang = x.lang and n.lang = x.lang
        and l.phrase = array_to_string(x.w[1:j], ' ') and r.phrase = array_to_string(x.w[j + 1:x.k], ' ')),
b as (select * from s qualify row_number() over (partition by lang, phrase order by score, j) = 1)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from b qualify rank <= 2000
"""

ORACLE = {"op6_licenses": _licenses(), "op2_mixing": MIX, "op4_warc": WARC, "op12_phrases": PHRASES}
