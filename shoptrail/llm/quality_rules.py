"""Quality rules with risk-controlled thresholds. Built-in expressions only.

A base rule rejects short and repetitive texts. Further rules compare a measure of the text with a
cutoff that labelled holdouts certify: among documents labelled good, the share that all rules together reject
is at most ``RISK`` in each stratum. Each rule has an equal part of that share, and an exact binomial bound at an error
level that is split over all (stratum, rule, cutoff) tests made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shoptrail.llm.common import BLANK_CHARS, BLANKS, cut_lineage, words

#: Fixed values of the rules: symbols, and limits of the base rule.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MOST_REPEATED_PERCENT = 50
#: Strata: texts by number of words, from each of these numbers on.
STRATA = (0, 100, 300, 1_000, 4_000)
#: Measures, all shares from 0 to 1; a rule rejects what is above its cutoff.
RULES = ("symbol_share", "dup_line_share", "repeat_share", "upper_share", "exclaim_share")
CUTOFFS = tuple(i / 40 for i in range(1, 40))
#: Highest share of good documents that all rules together may reject in a stratum, and error level of all tests.
RISK = 0.01
ERROR = 0.05


def repeated_words(tokens: Column) -> Column:
    """Number of words that stand in a 3-word window occurring twice or more in the text.

    Windows are sorted with their positions; equal neighbours are repeats. Each repeated window
    covers 3 words, less what the next one covers too.
    """
    spots = F.when(
        F.size(tokens) >= 3,
        F.transform(
            F.sequence(F.lit(1), F.size(tokens) - 2),
            lambda i: F.struct(
                F.concat_ws(" ", F.get(tokens, i - 1), F.get(tokens, i), F.get(tokens, i + 1)).alias("w"), i.alias("i")
            ),
        ),
    )
    return spots


def measured(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """One narrow row per document with the base counts and the measures; null texts have no words.

    The arrays exist only inside a row, one step at a time, and are linear in its text; sorting makes
    the repeats n log n.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    step = docs.select(F.col(id_column), value.alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(f"[^{BLANKS}]"))
    step = step.withColumns(
        {
            "word_chars": F.length(F.translate("text", BLANK_CHARS, "")).cast("bigint"),
            "n_symbols": (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("bigint"),
            "n_exclaim": (F.length("text") - F.length(F.translate("text", "!", ""))).cast("bigint"),
            "n_upper": (F.length("text") - F.length(F.regexp_replace("text", "\\p{Lu}+", ""))).cast("bigint"),
            "lines": lines,
            "tokens": words(F.col("text")),
        }
    )
    step = step.withColumns(
        {
            "n_words": F.size("tokens").cast("bigint"),
            "n_lines": F.size("lines").cast("bigint"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint"),
            "spots": repeated_words(F.col("tokens")),
        }
    ).drop("lines", "tokens", "text")
    step = step.withColumn("spots", F.array_sort("spots"))
    same = lambda i, j: F.get(F.col("spots"), i)["w"] == F.get(F.col("spots"), j)["w"]
    repeats = F.filter("spots", lambda x, k: F.coalesce(same(k, k - 1), F.lit(False)) | F.coalesce(same(k, k + 1), F.lit(False)))
    step = step.withColumn("at", F.array_sort(F.transform(repeats, lambda x: x["i"]))).drop("spots")
    covered = F.aggregate(
        "at",
        F.struct(F.lit(0).alias("n"), F.lit(-2).alias("end")),
        lambda acc, i: F.struct(
            (acc["n"] + F.lit(3) - F.greatest(F.lit(0), acc["end"] - i + 1)).alias("n"), (i + 2).alias("end")
        ),
        lambda acc: acc["n"],
    )
    step = step.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint")).drop("at")
    share = lambda a, b: F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0))
    return step.withColumns(
        {
            "symbol_share": share("n_symbols", "word_chars"),
            "dup_line_share": share("n_dup_lines", "n_lines"),
            "repeat_share": share("n_repeat_words", "n_words"),
            "upper_share": share("n_upper", "word_chars"),
            "exclaim_share": share("n_exclaim", "word_chars"),
            "stratum": sum((F.col("n_words") >= low).cast("int") for low in STRATA[1:]) + F.lit(0),
            "base_failed": (F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")),
        }
    )


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X from Binomial(n, p), exactly, by the recursion of its terms in logarithms."""
    odds = F.log(F.lit(p / (1 - p)))
    first = n.cast("double") * F.log(F.lit(1 - p))
    summed = F.aggregate(
        F.when(k >= 1, F.sequence(F.lit(1).cast("bigint"), k.cast("bigint"))).otherwise(F.array().cast("array<bigint>")),
        F.struct(first.alias("term"), first.alias("sum")),
        lambda acc, i: F.struct(
            (acc["term"] + F.log((n - i + 1) / i) + odds).alias("term"),
            (
                F.greatest(acc["sum"], acc["term"] + F.log((n - i + 1) / i) + odds)
                + F.log1p(F.exp(-F.abs(acc["sum"] - acc["term"] - F.log((n - i + 1) / i) - odds)))
            ).alias("sum"),
        ),
        lambda acc: acc["sum"],
    )
    return F.when(k >= n, F.lit(1.0)).otherwise(F.exp(summed))


def certified_cutoffs(measures: DataFrame, labels: DataFrame, id_column: str = "doc_id", risk: float = RISK, error: float = ERROR) -> DataFrame:
    """(stratum, rule, cutoff): of the certified cutoffs the one that tells bad from good best.

    Good documents above a cutoff are counted over all labelled ones that pass the base rule. A cutoff
    is certified if so few of n good documents exceed it that a true share above ``risk`` / rules has at most
    the probability ``error`` / tests (Bonferroni). Documents that any of the rules rejects are no more than those that
    each rejects, so ``risk`` holds for the verdict. Of the certified ones the largest difference between
    bad and good shares wins, then the higher cutoff; rules that reject no more bad than good ones are
    left out. At most 5 x 5 rows. Labels that are null, or whose document is absent, do not count; of
    several labels for an id, the lowest counts.
    """
    label = labels.where("quality is not null").groupBy(id_column).agg(F.min("quality").alias("label"))
    known = measures.where("not base_failed").join(label, id_column)
    long = known.select("stratum", "label", F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), F.col(r).alias("value")) for r in RULES
    ])).alias("m")).select("stratum", "label", "m.*")
    # How many cutoffs a value exceeds: counts per step first, sums from above afterwards.
    steps = F.least(F.greatest(F.ceil(F.col("value") * 40) - 1, F.lit(0)), F.lit(len(CUTOFFS)))
    counted = long.groupBy("stratum", "rule", steps.cast("int").alias("above")).agg(
        F.count_if(F.col("label") > 0).alias("good"), F.count_if(F.col("label") <= 0).alias("bad")
    )
    grid = F.explode(F.sequence(F.lit(1), F.lit(len(CUTOFFS)))).alias("step")
    both = counted.select("*", grid).groupBy("stratum", "rule", "step").agg(
        F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad"),
        F.coalesce(F.sum(F.when(F.col("above") >= F.col("step"), F.col("good"))), F.lit(0)).alias("k_good"),
        F.coalesce(F.sum(F.when(F.col("above") >= F.col("step"), F.col("bad"))), F.lit(0)).alias("k_bad"),
    )
    tests = len(STRATA) * len(RULES) * len(CUTOFFS)
    each = risk / len(RULES)
    gain = F.col("k_bad") / F.greatest("n_bad", F.lit(1)) - F.col("k_good") / F.greatest("n_good", F.lit(1))
    # Above the expected share nothing can be certified, so the sum has few terms.
    safe = both.where(F.col("k_good") <= F.lit(each) * F.col("n_good")).withColumn("gain", gain)
    safe = safe.where((binomial_tail(F.col("k_good"), F.col("n_good"), each) <= error / tests) & (F.col("gain") > 0))
    best = safe.groupBy("stratum", "rule").agg(F.max(F.struct("gain", "step")).alias("best"))
    return best.select("stratum", "rule", (F.col("best.step") / 40).alias("cutoff"))


def apply_rules(docs: DataFrame, labels: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept).

    Without usable labels no cutoff is certified and the base rule alone decides. Repeated rows and
    rows without id are judged like any other. Texts are read once: the measures, some numbers a row,
    are checkpointed, and both the cutoffs and the verdicts come from them.
    """
    measures = cut_lineage(measured(docs, text, id_column))
    rejected = F.lit(False)
    # At most one row per stratum and rule: 25.
    for row in certified_cutoffs(measures, labels, id_column).collect():
        rejected |= (F.col("stratum") == row["stratum"]) & (F.col(row["rule"]) > row["cutoff"])
    return measures.select(
        id_column, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~rejected).alias("kept"),
    )
