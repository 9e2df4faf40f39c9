"""Text column helpers: identifier normalisation, folding, tolerant column picks."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from stockweave.functions.numbers import as_col

NO_VALUE = ("", "NAN", "NONE", "NAT")


def nfkc(c: str | Column) -> Column:
    """Unicode NFKC. The JVM normaliser runs only for values with non-ASCII text."""
    value = as_col(c).cast("string")
    composed = F.java_method(
        F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), value, F.lit(True)
    )
    return F.when(value.rlike("[^\\x00-\\x7F]"), composed).otherwise(value)


def _tidy(value: Column) -> Column:
    return F.upper(F.regexp_replace(value, "^\\s+|\\s+$", ""))


def norm_id(c: str | Column) -> Column:
    """Identifier key: NFKC, trimmed, upper case; blank-like words become null."""
    value = as_col(c).cast("string")
    # Trimming plain ASCII needs no regular expression; the characters are those of its \\s.
    ascii_key = F.upper(F.btrim(value, F.lit(" \t\n\x0b\f\r")))
    key = F.when(value.rlike("[^\\x00-\\x7F]"), _tidy(nfkc(value))).otherwise(ascii_key)
    return F.when(~key.isin(*NO_VALUE), key)


def plain_id(c: str | Column) -> Column:
    """norm_id for columns known to hold ASCII text only."""
    key = F.upper(F.trim(as_col(c).cast("string")))
    return F.when(~key.isin(*NO_VALUE), key)


def norm(c: str | Column) -> Column:
    """Merchandising key: trimmed, upper case; blank and NAN become null."""
    key = _tidy(as_col(c).cast("string"))
    return F.when(~key.isin("", "NAN"), key)


def fold(c: str | Column) -> Column:
    """Only the letters and digits of a name, lower case."""
    return F.regexp_replace(F.lower(as_col(c)), "[^a-z0-9]+", "")


def fold_words(c: str | Column) -> Column:
    """Lower case, every run of other characters one space."""
    return F.trim(F.regexp_replace(F.lower(as_col(c)), "[^a-z0-9]+", " "))


def fold_separators(c: str | Column) -> Column:
    """Lower case without spaces, dashes and underscores."""
    return F.regexp_replace(F.lower(as_col(c)), "[\\s_\\-]+", "")


def fold_name(name: str) -> str:
    return re.sub(r"[^a-z0-9]+", "", str(name).lower())


def clean_header(name: str) -> str:
    return str(name).replace("\u00a0", " ").strip().strip('"')


def clean_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_header(c) for c in df.columns])


def flatten_headers(df: DataFrame) -> DataFrame:
    """Collapse whitespace inside column names; the data is untouched."""
    return df.toDF(*[" ".join(c.split()) for c in df.columns])


def pick_column(df: DataFrame, *wanted: str) -> str | None:
    """First wanted name present: exact without case, then as a substring."""
    for probe in wanted:
        want = probe.strip().lower()
        for match in (lambda c: c.strip().lower() == want, lambda c: want in c.strip().lower()):
            hit = next((c for c in df.columns if match(c)), None)
            if hit:
                return hit
    return None


def pick_folded(df: DataFrame, *wanted: str) -> str | None:
    """First wanted name present when both sides are reduced to letters and digits."""
    have = {fold_name(c): c for c in df.columns}
    return next((have[fold_name(w)] for w in wanted if fold_name(w) in have), None)


def pick_prefix(df: DataFrame, prefix: str) -> str | None:
    """First column whose folded name starts with the folded prefix."""
    return next((c for c in df.columns if fold_name(c).startswith(fold_name(prefix))), None)
