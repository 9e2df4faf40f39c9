"""Input folder to file table and cell rows.

Only file metadata is ever small here; contents are always read by Spark in
splits, so one very large extract does not land in one task.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from stockweave import schemas as S
from stockweave.session import cut_lineage

# Bytes 0x80-0x9F of code page 1252 (fixed values; five of them are unused there).
_C1 = "".join(chr(c) for c in range(0x80, 0xA0) if c not in (0x81, 0x8D, 0x8F, 0x90, 0x9D))
_CP1252 = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"

HEAD_ROWS = 25
#: Lines of a block are looked at in parts of at most 2^16.
PART_BITS = 16


def _root(path: str) -> str:
    return path.split(":", 1)[-1].rstrip("/") if "://" not in path else "/" + path.split("://", 1)[1].split("/", 1)[-1].rstrip("/")


def _plain(path: Column) -> Column:
    """Path without its scheme, so listings and readers agree."""
    return F.regexp_replace(path, "^[a-z0-9]+:/+", "/")


def _unmarked(text: Column) -> Column:
    """Text without a byte order mark before it."""
    return F.when(F.startswith(text, F.lit("\ufeff")), F.substr(text, F.lit(2))).otherwise(text)


def _inside(path: Column, root: str) -> Column:
    base = F.lit(_root(root))
    return F.ltrim(F.substring(path, F.instr(path, base) + F.length(base) + 1, F.length(path)), F.lit("/"))


def _places(path: Column, root: str) -> tuple[Column, Column, Column]:
    """(folders below the root, file name, lower-case suffix) of a plain path."""
    parts = F.split(_inside(path, root), "/")
    name = F.element_at(parts, -1)
    return F.slice(parts, F.lit(1), F.size(parts) - 1), name, F.lower(F.regexp_extract(name, "\\.([^.]+)$", 1))


def wanted(path: Column, root: str) -> Column:
    """Whether the rules on name and folders admit a file.

    Temporary and control files, archives, scratch and earlier outputs are left
    out, whatever their depth.
    """
    _, name, suffix = _places(path, root)
    # Tested for every line that is read: one pattern instead of a function over the list of folders.
    closed = F.lower(_inside(path, root)).rlike(f"(^|/)(_[^/]*|{'|'.join(map(re.escape, S.EXCLUDED_FOLDERS))})/")
    return ~closed & ~name.startswith("~$") & ~name.startswith(".") & ~F.lower(name).isin(*S.CONTROL_FILES) & suffix.isin(*S.INPUT_SUFFIXES)


def file_table(listing: DataFrame, root: str) -> DataFrame:
    """Files to load from (path, modificationTime, length)."""
    plain = listing.select(_plain(F.col("path")).alias("path"), F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))
    folders, name, suffix = _places(F.col("path"), root)
    return plain.filter(wanted(F.col("path"), root)).select(
        "path", name.alias("name"), F.array_join(folders, "/").alias("folder"), suffix.alias("suffix"), "modified", "bytes"
    )


def scan_inputs(spark: SparkSession, root: str) -> DataFrame:
    """A fresh listing per run: a file deleted at the source is gone from the next report."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    # Without the content column only file metadata is touched.
    return file_table(listing.select("path", "modificationTime", "length"), root)


def read_lines(spark: SparkSession, root: str, only: str | None = None) -> DataFrame:
    """Every CSV line with its file and its place: (path, block, seq, value).

    ``block`` and ``seq`` order the lines of a file without numbering them,
    which would need the whole file in one task. Only files of the file table
    are read: their names are a filter on file metadata, which Spark applies to
    the listing. Blank lines stay, as a quoted cell may hold them.
    ``only``: the path of the one file to read, whatever the rules say of it.
    """
    below = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.[cC][sS][vV]")
    file, path = F.col("_metadata.file_path").alias("_file"), _plain(F.col("path"))
    listed = below.format("binaryFile").load(root).select(file, path.alias("path"))
    # The rules are applied once per file: as a filter on lines they would be evaluated for each of them.
    files = cut_lineage(listed.filter(wanted(F.col("path"), root) if only is None else F.col("path") == _plain(F.lit(only))), "listing")
    # Names as the readers report them; Spark holds all of them on the driver anyway, and leaves out other files when it lists.
    names = [r[0] for r in files.select("_file").collect()]
    lines = below.format("text").load(root).filter(F.col("_metadata.file_path").isin(names)).select(
        file, F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq"), F.col("value")
    )
    return lines.join(files, "_file").select("path", "block", "seq", "value")


def _stays_open(is_open: Column, piece: Column) -> Column:
    """Whether a quoted cell is open after the text between two commas."""
    rest = F.when(is_open, piece).otherwise(F.substr(piece, F.lit(2)))
    return (is_open | F.startswith(piece, F.lit('"'))) & ~F.contains(F.replace(rest, F.lit('""'), F.lit("")), F.lit('"'))


def _open_after(value: Column, inside: bool) -> Column:
    """Whether a line leaves a quoted cell open, if it begins outside (or inside) of one.

    A quote opens a cell only as its first character and, unless doubled,
    closes it; any other quote is text (an inch mark).
    """
    return F.when(F.contains(value, F.lit('"')), F.aggregate(F.split(value, ","), F.lit(inside), _stays_open)).otherwise(F.lit(inside))


def join_records(lines: DataFrame, profile: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lines as records, paths whose last quoted cell is never closed).

    A line break inside a quoted cell belongs to its cell. Only files in which
    some line leaves a cell open can hold such a break. A line sets, swaps or
    keeps the state (outside or inside a cell), so states are found within each
    part of a block and carried from part to part: no task needs a whole file,
    nor a whole block. A file that ends inside a cell keeps its lines as they are.
    """
    odd = profile.filter("odd").select("path")
    filled = F.trim("value") != ""
    # Names of files, which the driver has listed; as a filter they keep other files' lines from being read.
    names = [r[0] for r in odd.collect()]
    if not names:
        return lines.filter(filled), odd
    plain, mine = lines.filter(~F.col("path").isin(names)), lines.filter(F.col("path").isin(names))
    part = ["path", "block", "_part"]
    order = Window.partitionBy(*part).orderBy("seq")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    # After a line the state is (what the last setting line left, else the state before the part) + swaps, modulo 2.
    marked = (
        mine.withColumn("_part", F.shiftright("seq", PART_BITS))
        .withColumns({"_out": _open_after(F.col("value"), False), "_in": _open_after(F.col("value"), True)})
        .withColumn("_swap", (F.col("_out") & ~F.col("_in")).cast("int"))
        .withColumn("_swaps", F.sum("_swap").over(upto))
        .withColumn("_set", F.last(F.when(F.col("_out") == F.col("_in"), F.col("_out").cast("int") + F.col("_swaps")), True).over(upto))
        .withColumn("_set_before", F.lag("_set").over(order))
    )

    def outside(before: Column) -> Column:
        """Whether a line begins a record, by the state before its part."""
        return (F.coalesce("_set_before", before) + F.col("_swaps") - F.col("_swap")) % 2 == 0

    # One row per part of a file, written: what is joined with the lines below is then known to be small.
    along = Window.partitionBy("path").orderBy("block", "_part")
    blocks = cut_lineage(
        # The last record that begins in a part, for either state before it.
        marked.groupBy(*part).agg(
            F.max_by(F.struct("_set", "_swaps"), "seq").alias("_end"), *[F.max(F.when(outside(F.lit(b)), F.col("seq"))).alias(f"_last{b}") for b in (0, 1)]
        )
        .withColumn("_flips", F.sum(F.when(F.col("_end._set").isNull(), F.col("_end._swaps")).otherwise(0)).over(along))
        .withColumn("_fixed", F.last(F.when(F.col("_end._set").isNotNull(), F.col("_end._set") + F.col("_end._swaps") + F.col("_flips")), True).over(along))
        .withColumn("_after", (F.coalesce("_fixed", F.lit(0)) + F.col("_flips")) % 2)
        .withColumn("_begin", F.lag("_after", 1, 0).over(along))
        .withColumn("_latest", F.when(F.col("_begin") == 0, F.col("_last0")).otherwise(F.col("_last1")))
        # The record that an earlier part began.
        .withColumn("_carried", F.last(F.when(F.col("_latest").isNotNull(), F.struct("block", F.col("_latest").alias("seq"))), True).over(along.rowsBetween(Window.unboundedPreceding, -1)))
        .select(*part, "_after", "_begin", "_carried"),
        "parts",
    )
    unclosed = cut_lineage(blocks.groupBy("path").agg(F.max_by("_after", F.struct("block", "_part")).alias("_last")).filter("_last = 1").select("path"), "unclosed")
    begun = marked.join(blocks.drop("_after"), part).withColumn(
        "_start", F.last(F.when(outside(F.col("_begin")), F.struct("block", "seq")), True).over(upto)
    )
    parts = F.array_sort(F.collect_list(F.struct("block", "seq", "value")))
    whole = begun.join(unclosed, "path", "left_anti").withColumn("_record", F.coalesce("_start", "_carried"))
    joined = whole.groupBy("path", "_record").agg(parts.alias("_parts")).select(
        "path", F.col("_record.block").alias("block"), F.col("_record.seq").alias("seq"),
        F.array_join(F.transform("_parts", lambda p: p["value"]), "\n").alias("value"),
    )
    left = mine.join(unclosed, "path", "left_semi")
    return plain.unionByName(joined).unionByName(left).filter(filled), unclosed


def block_starts(lines: DataFrame) -> DataFrame:
    """First place of every block."""
    return lines.groupBy("path", "block").agg(F.min("seq").alias("_start"))


def content_profile(lines: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """One pass over all lines: per file its rows, content digest and whether it is UTF-8.

    The digest adds hashes of the lines with their places, so it merges
    map-side; files of equal digest and size hold the same lines in the same
    order. A place is the line's number within its block: files of one size
    are cut into the same blocks. ``starts``: the blocks' first places, if at hand.
    """
    starts = block_starts(lines) if starts is None else starts
    lines = lines.join(starts, ["path", "block"]).withColumn("_nth", F.col("seq") - F.col("_start")).filter("trim(value) <> ''")
    h = F.xxhash64("block", "_nth", "value")
    return lines.groupBy("path").agg(
        F.bool_or(_open_after(_unmarked(F.col("value")), False)).alias("odd"),
        F.count(F.lit(1)).alias("rows"),
        F.concat_ws(
            "-", F.sum(h.cast("decimal(38,0)")).cast("string"), F.bit_xor(F.xxhash64(F.lit("x"), "block", "_nth", "value")).cast("string"),
            F.count(F.lit(1)).cast("string"),
        ).alias("digest"),
        F.bool_and(F.is_valid_utf8("value")).alias("utf8"),
    )


def decode_lines(lines: DataFrame, profile: DataFrame) -> DataFrame:
    """Lines as text: UTF-8 (with or without mark) per file, else code page 1252."""
    western = F.translate(F.decode(F.col("value").cast("binary"), "ISO-8859-1"), _C1, _CP1252)
    known = profile.select("path", "utf8")
    text = F.when(F.col("utf8"), F.col("value")).otherwise(western)
    return lines.join(known, "path").select(
        "path", "block", "seq", _unmarked(text).alias("value")
    )


def split_cells(value: Column) -> Column:
    """Cells of a heading line; commas of quoted cells stay inside them."""
    def step(done, piece):
        before = F.when(done["open"], F.slice(done["cells"], F.lit(1), F.size(done["cells"]) - 1)).otherwise(done["cells"])
        cell = F.when(done["open"], F.concat(F.element_at(done["cells"], -1), F.lit(","), piece)).otherwise(piece)
        return F.struct(F.concat(before, F.array(cell)).alias("cells"), _stays_open(done["open"], piece).alias("open"))

    none = F.struct(F.array().cast("array<string>").alias("cells"), F.lit(False).alias("open"))
    cells = F.aggregate(F.split(value, ","), none, step)["cells"]
    bare = F.transform(cells, lambda c: F.replace(c, F.lit("\u00a0"), F.lit(" ")))
    return F.transform(bare, lambda c: F.trim(F.when(c.rlike('^\\s*"'), F.regexp_replace(c, '^\\s*"|"\\s*$', "")).otherwise(c)))


def head_rows(lines: DataFrame, n: int = HEAD_ROWS) -> DataFrame:
    """The first lines of every file, numbered from 0, as cell rows."""
    spec = Window.partitionBy("path").orderBy("seq")
    # A bare row number under the filter: only then Spark keeps the first rows before it shuffles.
    first = lines.filter("block = 0").withColumn("_n", F.row_number().over(spec)).filter(F.col("_n") <= n)
    return first.select("path", (F.col("_n") - 1).alias("row_idx"), "block", "seq", split_cells(F.col("value")).alias("cells"))


def body_cells(lines: DataFrame, files: DataFrame, columns: int) -> DataFrame:
    """Lines below the header as cell arrays.

    ``files``: path, header_block, header_seq (place of the header line); its
    other columns are kept.
    ``columns``: width of the widest header; the CSV parser needs a bound.
    """
    below = lines.join(files, "path").filter(
        (F.col("block") > F.col("header_block"))
        | ((F.col("block") == F.col("header_block")) & (F.col("seq") > F.col("header_seq")))
    )
    schema = ", ".join(f"c{i} string" for i in range(columns))
    parsed = F.from_csv("value", F.lit(schema), {"quote": '"', "escape": '"', "mode": "PERMISSIVE"})
    steer = [c for c in files.columns if c not in ("path", "header_block", "header_seq")]
    return below.withColumn("_row", parsed).select(
        "path", "block", "seq", *steer, F.array(*[F.col(f"_row.c{i}") for i in range(columns)]).alias("cells")
    )


def input_freshness(files: DataFrame, expected: DataFrame, now, stale_after: int = S.STALE_AFTER_DAYS) -> DataFrame:
    """Per expected folder: files, newest, age in days, and whether it is empty or stale.

    ``expected``: folder (a config table).
    """
    seen = files.groupBy("folder").agg(F.count(F.lit(1)).alias("files"), F.max("modified").alias("newest"))
    age = F.floor(F.timestamp_diff("HOUR", F.col("newest"), F.lit(now)) / 24)
    return expected.join(seen, "folder", "left").select(
        "folder", F.coalesce("files", F.lit(0).cast("long")).alias("files"), "newest", age.alias("age_days"),
        F.when(F.col("newest").isNull(), "EMPTY").when(age > stale_after, "STALE").otherwise("OK").alias("state"),
    )


def input_fingerprint(files: DataFrame, extra: str = "") -> DataFrame:
    """One row: a hash that changes when any file is added, removed or altered.

    Per-file hashes are added up, so millions of files need neither a sort nor
    one task holding every name.
    """
    line = F.sha2(F.concat_ws("|", F.concat_ws("/", "folder", "name"), "file_id", "version", F.col("bytes").cast("string")), 256)
    word = lambda i: F.conv(F.substring(line, i, 15), 16, 10).cast("decimal(38,0)")
    sums = files.agg(
        F.count(F.lit(1)).alias("files"), F.sum(word(1)).alias("a"), F.sum(word(16)).alias("b"), F.sum(word(31)).alias("c")
    )
    parts = [F.coalesce(F.col(n).cast("string"), F.lit("0")) for n in ("files", "a", "b", "c")]
    return sums.select("files", F.substring(F.sha2(F.concat_ws("|", *parts, F.lit(extra)), 256), 1, 16).alias("fingerprint"))


def should_skip(fingerprint: DataFrame, last_status: DataFrame, outputs_complete: bool) -> DataFrame:
    """One row: true when the inputs are those of the last good run and its outputs exist."""
    last = last_status.agg(F.max_by(F.struct("fingerprint", "ok"), "started").alias("last"))
    same = F.col("last.ok") & (F.col("last.fingerprint") == F.col("fingerprint")) & F.lit(outputs_complete)
    return fingerprint.crossJoin(F.broadcast(last)).select(  # 1 x 1 row
        "fingerprint", F.coalesce(same, F.lit(False)).alias("skip")
    )


def profile_table(df: DataFrame, column: str, max_values: int = 25) -> DataFrame:
    """Rows, columns and the most frequent values of one column."""
    value = F.coalesce(F.nullif(F.trim(F.col(column).cast("string")), F.lit("")), F.lit("(blank)"))
    counts = df.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("count"))
    total = df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))
    return counts.orderBy(F.desc("count"), "value").limit(max_values).crossJoin(F.broadcast(total))  # one row


class CombineError(ValueError):
    """Tables that must not be stacked."""


def table_digest(df: DataFrame) -> DataFrame:
    h = F.xxhash64(*df.columns)
    return df.agg(F.sum(h.cast("decimal(38,0)")).alias("a"), F.bit_xor(F.xxhash64(F.lit(1), *df.columns)).alias("b"), F.count(F.lit(1)).alias("n"))


def combine_same_schema(parts: dict[str, DataFrame]) -> DataFrame:
    """Stack per-facility tables; refuses unequal headers and identical bodies.

    An export that ignores the facility returns the same rows for each one;
    stacking those would multiply every figure.
    """
    names = list(parts)
    header = parts[names[0]].columns
    for name in names:
        if parts[name].columns != header:
            raise CombineError(f"header mismatch in {name}; refusing to combine")
    digests = {}
    for name in names:
        key = tuple(table_digest(parts[name]).first())
        if key in digests:
            raise CombineError(f"{name} holds the same rows as {digests[key]}; the export is not facility-scoped")
        digests[key] = name
    out = parts[names[0]]
    for name in names[1:]:
        out = out.unionByName(parts[name])
    return out
