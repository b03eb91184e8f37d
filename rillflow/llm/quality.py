"""Quality by weak supervision (DataFrame functions only).

Rules look at one text each and vote good (1), bad (-1) or abstain (0). Expectation-maximisation over the whole
table estimates how often each rule is right on good and on bad texts and the share of good texts; a text is
kept when its posterior probability of being good reaches ``keep_at``. The model sees texts only through their
vote vectors, so EM runs on counts per vote pattern: at most 3 ** len(RULES) rows, whatever the table's size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, WORD, cut, reliable

#: name -> (votes good when, votes bad when); over the columns of ``measures``. Fixed values of this operator.
RULES: dict[str, tuple[str, str]] = {
    "word_length": ("word_chars between 3 * n_words and 9 * n_words", "word_chars < 2.2 * n_words or word_chars > 14 * n_words"),
    "symbols": ("100 * n_symbols <= 2 * n_words", "100 * n_symbols >= 15 * n_words"),
    "dup_lines": ("100 * n_dup_lines <= 15 * n_lines", "100 * n_dup_lines >= 35 * n_lines"),
    "repeats": ("100 * n_repeat_words <= 20 * n_words", "100 * n_repeat_words > 35 * n_words"),
    "bare_words": ("100 * n_bare_words <= 10 * n_words", "100 * n_bare_words >= 20 * n_words"),
    "line_words": ("n_words >= 6 * n_lines", "n_words < 3 * n_lines"),
    "letters": ("100 * n_letters >= 80 * word_chars", "100 * n_letters < 70 * word_chars"),
    "sentence_ends": ("100 * n_end_lines >= 60 * n_lines", "100 * n_end_lines < 20 * n_lines"),
}
ROUNDS, SETTLED, KEEP_AT = 25, 1e-4, 0.5
VOTES = (1, 0, -1)
#: Where EM starts, and what it holds on to with the weight of ``PRIOR_SHARE`` of all rows: good texts are mostly
#: voted good, bad ones are caught by some of the rules. Keeps "good" meaning good.
PRIOR_GOOD, PRIOR_SHARE = 0.85, 0.005
PRIOR = {"good": {1: 0.9, 0: 0.08, -1: 0.02}, "bad": {1: 0.5, 0: 0.15, -1: 0.35}}


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id and whole-text counts.

    ``n_words``, ``word_chars`` (code points in words), ``n_symbols``, ``n_dup_lines`` (lines with a word equal to
    an earlier line), ``n_repeat_words`` (words inside a 3-word window found twice or more), ``n_lines`` (lines
    with a word), ``n_end_lines`` (those ending like a sentence), ``n_letters``, ``n_bare_words`` (words without letter or digit). Null text has none of anything.
    Windows are told apart by 64-bit hashes within one text.
    """
    t = F.col("_t")
    base = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    words = F.array_remove(F.split(t, BLANKS), "")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    step = base.select(id_col, "_t", words.alias("_w"), lines.alias("_l"))
    w = F.col("_w")
    step = step.select(
        id_col, F.size("_w").alias("_n"),
        F.transform(F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))),
                    lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))).alias("_h"),
        (F.length(t) - F.regexp_count(t, F.lit(r"[\x20\x09-\x0D]"))).alias("_chars"),
        F.regexp_count(t, F.lit(r"[#*$%&|<>]")).alias("_sym"),
        F.regexp_count(t, F.lit(r"\p{L}")).alias("_letters"),
        F.size(F.filter("_w", lambda x: ~x.rlike(r"[\p{L}\p{N}]"))).alias("_bare"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).alias("_dup"), F.size("_l").alias("_lines"),
        F.size(F.filter("_l", lambda x: x.rlike(r"[.!?:…\"'”»)][\x20\x09-\x0D]*$"))).alias("_ends"))
    once = F.size("_h") == F.size(F.array_distinct("_h"))
    order = F.when(~once, F.array_sort(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("p")))))
    step = step.withColumn("_s", order)
    m = F.size("_s") - 1
    twice = F.flatten(F.filter(
        F.zip_with(F.slice("_s", F.lit(1), m), F.slice("_s", F.lit(2), m),
                   lambda a, b: F.when(a["h"] == b["h"], F.array(a["p"], b["p"]))), lambda x: x.isNotNull()))
    step = step.withColumn("_p", F.when(F.col("_s").isNotNull(), twice))
    covered = F.size(F.array_distinct(F.flatten(F.transform(F.array_distinct("_p"), lambda p: F.array(p, p + 1, p + 2)))))
    return step.select(
        id_col, F.col("_n").cast("long").alias("n_words"), F.col("_chars").cast("long").alias("word_chars"),
        F.col("_sym").cast("long").alias("n_symbols"), F.col("_dup").cast("long").alias("n_dup_lines"),
        F.when(F.col("_p").isNull(), F.lit(0)).otherwise(covered).cast("long").alias("n_repeat_words"),
        F.col("_lines").cast("long").alias("n_lines"), F.col("_ends").cast("long").alias("n_end_lines"),
        F.col("_letters").cast("long").alias("n_letters"), F.col("_bare").cast("long").alias("n_bare_words"))


def votes() -> list[Column]:
    return [F.expr(f"case when {good} then 1 when {bad} then -1 else 0 end").alias(f"v_{name}")
            for name, (good, bad) in RULES.items()]


def _log_odds(model: dict) -> Column:
    """Log odds of good, as a sum over the rules' votes."""
    total = F.lit(math.log(model["good"] / (1 - model["good"])))
    for name, rates in model["rates"].items():
        v = F.col(f"v_{name}")
        weigh = {vote: math.log(rates["good"][vote] / rates["bad"][vote]) for vote in VOTES}
        total = total + F.when(v == 1, weigh[1]).when(v == -1, weigh[-1]).otherwise(weigh[0])
    return total


def fit(voted: DataFrame, rounds: int = ROUNDS) -> dict:
    """EM over vote patterns: ``good`` (share of good texts) and, per rule, how often it votes good (1, its
    accuracy on good texts), bad (-1, its accuracy on bad ones) or abstains (0) on good and on bad texts.

    Each round is one aggregate over the pattern table; the driver holds only the parameters. No rows: the prior.
    """
    names = list(RULES)
    patterns = reliable(voted.groupBy(*[f"v_{n}" for n in names]).count())  # at most 3 ** len(RULES) rows
    rows = patterns.agg(F.sum("count")).first()[0] or 0
    model = {"good": PRIOR_GOOD, "rates": {n: {y: dict(PRIOR[y]) for y in PRIOR} for n in names}}
    for _ in range(rounds if rows else 0):
        p = 1 / (1 + F.exp(-_log_odds(model)))
        sums = [F.sum(F.col("count") * p).alias("good")]
        for n in names:
            for y, w in (("good", p), ("bad", 1 - p)):
                sums += [F.sum(F.when(F.col(f"v_{n}") == v, F.col("count") * w).otherwise(0.0)).alias(f"{n} {y} {v}")
                         for v in VOTES]
        s = patterns.agg(*sums).first()
        extra = PRIOR_SHARE * rows
        new = {"good": min(0.99, max(0.01, s["good"] / rows)), "rates": {}}
        for n in names:
            new["rates"][n] = {}
            for y in PRIOR:
                got = {v: s[f"{n} {y} {v}"] + extra * PRIOR[y][v] for v in VOTES}
                new["rates"][n][y] = {v: got[v] / sum(got.values()) for v in VOTES}
        moved = max(abs(model["rates"][n][y][v] - new["rates"][n][y][v]) for n in names for y in PRIOR for v in VOTES)
        model = new
        if moved < SETTLED:
            break
    return model


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_at: float = KEEP_AT) -> DataFrame:
    """One row per input row: id, the measures, ``base_failed``, ``p_good`` and ``kept``.

    Base: fewer than 50 words, or over half of the words in repeated 3-word windows, is never kept. Others are
    kept when the posterior of good is at least ``keep_at``. Null and empty texts fail the base. Repeated rows
    are judged one by one; an empty table gives no rows; further columns are ignored, whatever their names.
    """
    voted = cut(measures(docs, id_col, text_col).select("*", *votes()), "quality-votes")
    model = fit(voted)
    failed = F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")
    return (voted.withColumn("base_failed", failed).withColumn("p_good", 1 / (1 + F.exp(-_log_odds(model))))
            .withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= keep_at)))
