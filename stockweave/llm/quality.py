"""Quality rules under weak supervision.

Rules vote good (1), bad (-1) or abstain (0). Expectation-maximisation over
the counts of vote patterns estimates how often each rule votes what on good
and on bad documents; a document's posterior probability of being good
replaces "all rules must pass". DataFrame functions only: the driver sees the
pattern counts alone, at most 3 ** len(RULES) rows whatever the input size.

Defined cases: a null text counts as no words; an empty or null text fails the
base rules; rows are judged one by one, so repeated rows get equal verdicts;
an empty table gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from stockweave.llm import common as C

#: Fixed by the result contract.
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = r"[#*$%&|<>]"

ROUNDS = 60
KEEP_AT = 0.5
#: A rule's bad vote is meant to be precise: however the documents fall, it is taken to hit at most this share of good ones.
MAX_FALSE_ALARM = 0.005
#: Documents added to each vote of each class, so that a vote never seen has no infinite weight.
SMOOTHING = 0.5


def _bad(condition: Column) -> Column:
    return F.when(condition, -1).otherwise(0)


def _good(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """Votes from the measures. Signs of junk vote bad or abstain, signs of prose vote good or abstain."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    mean = F.col("word_chars") / n
    symbols, repeats, marks = F.col("n_symbols") / n, F.col("n_repeat_words") / n, F.col("n_marks") / n
    upper = F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1))
    lines = F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))
    return {
        "symbols": _bad(symbols > 0.2),
        "repeats": _bad(repeats > 0.3),
        "lines": _bad((lines > 0.7) & (F.col("n_lines") > 3)),
        "word_length": _bad((mean < 2) | (mean > 20)),
        "exclaims": _bad(marks > 0.4),
        "capitals": _bad((upper > 0.4) & (n > 10)),
        "length": _good(F.col("n_words") >= 30),
        "sentences": _good((F.col("n_ends") / n).between(0.015, 0.4)),
    }


RULES = ("symbols", "repeats", "lines", "word_length", "exclaims", "capitals", "length", "sentences")


def measures(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts over the whole text. Each select binds arrays that the next one's lambdas read."""
    read = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    split = read.select(
        "doc_id",
        C.words_of(F.col("__text")).alias("__words"),
        F.filter(F.split("__text", "\n"), lambda line: line.rlike(C.WORD)).alias("__lines"),
        F.regexp_count("__text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count("__text", F.lit("!")).cast("long").alias("n_marks"),
        F.regexp_count("__text", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count("__text", F.lit(r"[.?](?=\s|$)")).cast("long").alias("n_ends"),
    )
    hashed = split.select(
        "doc_id", "n_symbols", "n_marks", "n_upper", "n_ends",
        F.size("__words").cast("long").alias("n_words"),
        F.char_length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.transform("__words", lambda w: F.xxhash64(w)).alias("__hashes"),
    )
    kept = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_marks", "n_upper", "n_ends"]
    starts = F.sequence(F.lit(0), F.col("n_words").cast("int") - WINDOW)
    windows = hashed.select(
        *kept,
        F.when(
            F.col("n_words") > WINDOW,
            F.transform(starts, lambda i: F.xxhash64(*[F.get("__hashes", i + k) for k in range(WINDOW)])),
        ).alias("__windows"),
    )
    # Only texts with some repeated window pay for finding where it stands.
    ordered = windows.select(
        *kept,
        F.when(
            F.size(F.array_distinct("__windows")) < F.size("__windows"),
            F.array_sort(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).alias("__sorted"),
    )

    def repeated(at: Column) -> Column:
        same = lambda k: F.coalesce(F.get("__sorted", at)["h"] == F.get("__sorted", k)["h"], F.lit(False))
        return same(at - 1) | same(at + 1)

    places = ordered.select(
        *kept,
        F.when(
            F.col("__sorted").isNotNull(),
            F.array_sort(
                F.transform(
                    F.filter(F.sequence(F.lit(0), F.size("__sorted") - 1), repeated), lambda k: F.get("__sorted", k)["i"]
                )
            ),
        ).alias("__places"),
    )
    # Words covered: each window adds what the next one does not cover again.
    gaps = F.zip_with(
        F.slice("__places", F.lit(2), F.size("__places")),
        F.slice("__places", F.lit(1), F.size("__places") - 1),
        lambda b, a: F.least(b - a, F.lit(WINDOW)),
    )
    covered = F.aggregate(gaps, F.lit(WINDOW), lambda total, gap: total + gap)
    return places.select(*kept, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def estimate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = ROUNDS) -> tuple[float, list[dict]]:
    """EM over (votes, count) pairs: the share of good documents and, per rule, log P(vote | good) - log P(vote | bad)."""
    total = sum(n for _, n in patterns)
    if not total:
        return 0.5, []
    good = [0.05 if -1 in votes else 0.98 for votes, _ in patterns]
    share, tables = 0.5, []
    for _ in range(rounds):
        mass = sum(g * n for g, (_, n) in zip(good, patterns, strict=True))
        share = min(0.99, max(0.01, mass / total))
        tables = []
        for r in range(len(patterns[0][0])):
            seen = {v: [SMOOTHING, SMOOTHING] for v in (1, 0, -1)}
            for g, (votes, n) in zip(good, patterns, strict=True):
                seen[votes[r]][0] += g * n
                seen[votes[r]][1] += (1 - g) * n
            rates = [{v: s[c] / sum(t[c] for t in seen.values()) for v, s in seen.items()} for c in (0, 1)]
            rates[0][-1] = min(rates[0][-1], MAX_FALSE_ALARM)
            tables.append({v: math.log(rates[0][v]) - math.log(rates[1][v]) for v in seen})
        odds = [math.log(share / (1 - share)) + sum(t[v] for t, v in zip(tables, votes, strict=True)) for votes, _ in patterns]
        good = [1 / (1 + math.exp(-max(-500.0, min(500.0, o)))) for o in odds]
    return share, tables


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", keep_at: float = KEEP_AT) -> DataFrame:
    """One row per document: the measures, ``base_failed``, ``posterior`` and ``kept``."""
    votes = rules()
    rows = C.staged(measures(docs, key, text).withColumns({f"v_{r}": votes[r] for r in RULES}), "quality")
    names = [f"v_{r}" for r in RULES]
    counted = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).collect()
    share, tables = estimate(sorted((tuple(c[v] for v in names), c["n"]) for c in counted))
    odds = F.lit(math.log(share / (1 - share)))
    for name, weights in zip(names, tables, strict=False):
        odds = odds + F.when(F.col(name) == 1, F.lit(weights[1])).when(F.col(name) == -1, F.lit(weights[-1])).otherwise(F.lit(weights[0]))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    posterior = 1 / (1 + F.exp(-odds))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & (posterior >= keep_at)).alias("kept"), posterior.alias("posterior"),
    )
