"""A small table with the cases every operator must stand: nulls anywhere, empty and long texts, ties, repeated rows,
and extra columns whose names clash with results and work columns."""

import random

from pyspark.sql import functions as F, types as T

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = (
    "size", "shard", "slot", "law", "taken", "target", "source_size", "n_words", "n_removed", "kept", "component_id", "n_shingles", "root",
    "bucket", "payload", "decided", "h1", "h2", "d1", "d2", "n", "key", "ids", "score", "lang_pred", "held_out", "fingerprint", "guest",
    "license", "digest", "canonical_sha256", "found", "c0", "c1", "v", "part", "own", "grown_shard", "text_crc32", "at", "__found_x",
)


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abdeghiklmnoprstu") for _ in range(r.randint(2, 9))) for _ in range(words))


def rows() -> list[tuple]:
    base, passage, long = prose(1, 120), prose(2, 60), prose(3, 30_000)
    near = base.split()
    near[60] = "changed"
    out = [
        (1, base, "en", "a", 1), (2, base, "en", "a", 1), (2, base, "en", "a", 1), (3, " ".join(near), None, "b", None),
        (4, prose(4, 50) + "\n" + passage, "en", None, 5), (5, passage + "\t" + prose(5, 70), "fr", "c", 6), (6, long, "fr", "c", 7),
        (7, None, "en", "a", None), (8, "", "en", "b", 0), (9, " \t\n\x0b\x0c\r ", None, "b", 7), (10, "One two", "en", "b", 7),
        (11, "ONE two", "en", "b", 7), (None, prose(6, 40), "en", "a", 1), (None, prose(6, 40), "en", "a", 1), (None, None, None, None, None),
        (12, "naïve café ÀÉ   x y \U0001f600 ß " * 9, "fr", "é", 2), (13, "and " * 300, "en", "a", 1),
        (14, "!!! ### 123 *** $$$ %%%", "en", "a", 3), (15, "Released under the MIT Licence.\nCopyright 2020 X\n\nMIT license", "en", "a", 3),
        (16, "a" * 5000, "en", "z", 3), (17, "x\x00y \x1c z", None, "", 3), (-5, prose(7, 200), "fr", "b", 3), (2**40, base + " end", "en", "a", 1),
    ]
    return out + [(100 + i, prose(50 + i, 30 + i), ("en", "fr")[i % 2], f"s{i % 4}", i) for i in range(20)]


def documents(spark, clashes: bool = True):
    schema = T.StructType.fromDDL(SCHEMA)
    df = spark.createDataFrame(rows(), schema).repartition(3)
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHES)]) if clashes else df


def empty(spark):
    return spark.createDataFrame([], T.StructType.fromDDL(SCHEMA))


def bag(df, *columns) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def duck(spark_rows, sql: str, columns: list[str], name: str, schema: list[tuple[str, str]]) -> list[tuple]:
    """The SQL's rows over the given rows, in the order of ``bag``."""
    import duckdb

    con = duckdb.connect()
    con.execute(f"create table {name} ({', '.join(f'{n} {t}' for n, t in schema)})")
    con.executemany(f"insert into {name} values ({', '.join('?' * len(schema))})", spark_rows)
    return sorted((tuple(r) for r in con.sql(sql).select(*columns).fetchall()), key=repr)
