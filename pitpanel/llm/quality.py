"""Quality rules with risk-controlled thresholds (built-in expressions only).

Features of the whole text feed fixed base rules and a set of ratio rules "reject when
the ratio is over its cutoff". A ratio rule's cutoff is not guessed: among labelled good
documents (the holdout) of a stratum, a cutoff may be used only if the exact binomial
test rejects "the rule rejects more than ``alpha / rules`` of good documents" at level
``delta / (strata * rules)`` (Bonferroni over every stratum and rule; along the grid of one
rule the rejections only fall as the cutoff rises, so the strictest passing cutoff is a
fixed-sequence test from the lenient end). With probability 1 - delta no stratum loses
more than ``alpha`` of its good documents to these rules. A stratum with too few labelled
rows to prove anything gets no ratio rule.

Defined cases: a NULL text is empty (0 words: the base rules reject it); a NULL stratum is
a stratum of its own; repeated rows are judged one by one; a document labelled more than
once is good only if every label says so; an empty label table leaves the base rules alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.llm.base import staged, texts

SPACES = "[ \\t-\\r]"
SYMBOLS = "[#*$%&|<>]"
CAPITALS = "[A-Z]"
WINDOW = 8             # words, a power of two
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# Cutoffs offered to each ratio rule, strict to lenient.
GRIDS = {
    "symbol_ratio": (0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.8, 1.0, 1.5, 2.0),
    "capital_ratio": (0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9),
    "dup_line_ratio": (0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.5, 0.6, 0.7, 0.8),
    "repeat_ratio": (0.05, 0.1, 0.125, 0.15, 0.175, 0.2, 0.225, 0.25, 0.275, 0.3),
}


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES + "+"), "")


def window_hashes(words: Column, doublings: int = 3) -> Column:
    """Hashes of all windows of 2 ** ``doublings`` words: a window is hashed from its two halves."""
    def twice(x: Column, half: int) -> Column:
        return let(x, lambda a: F.zip_with(a, F.slice(a, half + 1, F.greatest(F.size(a), F.lit(1))),
                                           lambda p, q: F.when(q.isNotNull(), F.xxhash64(p, q))))

    x = words
    for i in range(doublings):
        x = twice(x, 1 << i)
    return F.filter(x, lambda h: h.isNotNull())


def _covered(window_hashes: Column) -> Column:
    """Words in windows whose hash occurs again: sort (hash, place), take the places that
    equal a neighbour, and add up what each place covers before the next one."""
    pairs = F.sort_array(F.transform(window_hashes, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

    def repeated(s: Column) -> Column:
        def place(e: Column, j: Column) -> Column:
            before = (j > 0) & (F.get(s, F.greatest(j - 1, F.lit(0)))["x"] == e["x"])
            after = F.get(s, j + 1)["x"] == e["x"]
            return F.when(before | F.coalesce(after, F.lit(False)), e["i"])
        return F.sort_array(F.filter(F.transform(s, place), lambda p: p.isNotNull()))

    def total(p: Column) -> Column:
        gaps = F.zip_with(p, F.slice(p, 2, F.greatest(F.size(p), F.lit(1))),
                          lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda acc, g: acc + g)

    return let(let(pairs, repeated), total)


def features(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """(doc_id, stratum, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ratios)."""
    text = F.col("text")
    d = texts(docs, F.col(stratum).cast("string").alias("stratum"))
    lines = F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit("[^ \\t-\\r]")))

    def count(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)).cast("long")

    d = d.select("doc_id", "stratum", words_of(text).alias("words"), lines.alias("lines"),
                 (F.length(text) - count(SPACES)).alias("word_chars"),
                 count(SYMBOLS).alias("n_symbols"), count(CAPITALS).alias("n_capitals"))
    n = F.size("words")
    windows = F.when(n > WINDOW, window_hashes(F.col("words")))
    d = d.select("doc_id", "stratum", "word_chars", "n_symbols", "n_capitals",
                 n.cast("long").alias("n_words"), windows.alias("windows"),
                 F.size("lines").cast("long").alias("n_lines"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"))
    repeats = F.when(F.col("windows").isNull()
                     | (F.size("windows") == F.size(F.array_distinct("windows"))), F.lit(0).cast("long")) \
        .otherwise(_covered(F.col("windows")))
    d = d.withColumn("n_repeat_words", repeats).drop("windows")

    def ratio(a: str, b: str) -> Column:
        return F.col(a).cast("double") / F.greatest(F.col(b), F.lit(1)).cast("double")

    return d.select("doc_id", "stratum", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    ratio("n_symbols", "n_words").alias("symbol_ratio"),
                    ratio("n_capitals", "word_chars").alias("capital_ratio"),
                    ratio("n_dup_lines", "n_lines").alias("dup_line_ratio"),
                    ratio("n_repeat_words", "n_words").alias("repeat_ratio"))


def _ln_gamma(x: Column) -> Column:
    """ln Gamma(x), x >= 1: Stirling's series at x + 8, brought back by the recurrence."""
    y = x + 8
    back = sum((F.log(x + j) for j in range(1, 8)), F.log(x))
    series = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - back


def binomial_cdf(n: Column, k: Column, p: float, terms: int = 5000) -> Column:
    """P(Binomial(n, p) <= k), summed from the k-th term down; past ``terms`` terms the rest is
    bounded from above by a geometric series, so the value never comes out too small. 1 where
    k / n reaches p (the test cannot pass there)."""
    n, k = n.cast("double"), k.cast("double")
    top = (_ln_gamma(n + 1) - _ln_gamma(k + 1) - _ln_gamma(n - k + 1)
           + k * math.log(p) + (n - k) * math.log(1 - p))
    steps = F.sequence(F.lit(0), F.least(k, F.lit(float(terms))).cast("int"))
    odds = (1 - p) / p

    def add(acc: Column, j: Column) -> Column:
        return F.struct((acc["term"] * (k - j) / (n - k + j + 1) * odds).alias("term"),
                        (acc["sum"] + acc["term"]).alias("sum"))

    run = F.aggregate(steps, F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum")), add,
                      lambda acc: acc["sum"] + acc["term"] / F.greatest(1 - k / (n - k + 1) * odds, F.lit(1e-9)))
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.least(F.exp(top) * run, F.lit(1.0)))


def thresholds(feats: DataFrame, labels: DataFrame, alpha: float = 0.02, delta: float = 0.05,
               grids: dict = GRIDS) -> DataFrame:
    """One row per stratum with labelled good rows: (stratum, n_good, a cutoff per rule or NULL)."""
    good = (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").alias("q"))
            .groupBy("doc_id").agg(F.min(F.coalesce("q", F.lit(0))).alias("q")).where("q = 1").select("doc_id"))
    held = feats.join(good, "doc_id", "left_semi")
    rejected = [F.sum((F.col(r) > c).cast("long")).alias(f"{r}_{i}")
                for r, grid in grids.items() for i, c in enumerate(grid)]
    counts = held.groupBy("stratum").agg(F.count(F.lit(1)).alias("n_good"), *rejected)
    counts = counts.withColumn("tests", F.count(F.lit(1)).over(Window.partitionBy()) * len(grids))
    # a row per stratum, rule and cutoff; of the cutoffs that pass, the strictest
    grid = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(float(c)).alias("cutoff"), F.col(f"{r}_{i}").alias("k"))
                     for r, cutoffs in grids.items() for i, c in enumerate(cutoffs)])
    passed = binomial_cdf(F.col("n_good"), F.col("k"), alpha / len(grids)) <= F.lit(delta) / F.col("tests")
    tried = counts.select("stratum", "n_good", "tests", F.inline(grid)).withColumn("passed", passed)
    return tried.groupBy("stratum", "n_good").agg(
        *[F.min(F.when(F.col("passed") & (F.col("rule") == r), F.col("cutoff"))).alias(f"{r}_max") for r in grids])


def judge(docs: DataFrame, labels: DataFrame, alpha: float = 0.02, delta: float = 0.05,
          stratum: str = "lang", grids: dict = GRIDS) -> DataFrame:
    """One row per document: counts, base_failed, kept, rejected_by (names of the rules, comma-joined)."""
    feats = staged(features(docs, stratum), "quality")
    limits = thresholds(feats, labels, alpha, delta, grids).withColumnRenamed("stratum", "s")
    d = feats.join(limits, F.col("stratum").eqNullSafe(F.col("s")), "left")
    base = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    over = F.concat_ws(",", *[F.when(F.col(r) > F.col(f"{r}_max"), F.lit(r)) for r in grids])
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    base.alias("base_failed"), (~base & (over == "")).alias("kept"), over.alias("rejected_by"))
