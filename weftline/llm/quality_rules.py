"""Quality rules whose cutoffs are certified on labelled documents.

Each rule rejects a document when a share (of symbols, upper-case characters, repeated lines or
words) lies above a cutoff. Per stratum and rule the cutoffs of a fixed grid are tested from the
mildest to the strictest. The null hypothesis is "this cutoff rejects more than ``ALPHA`` of the
good documents"; its exact p-value is the binomial tail P(X <= rejected | good, ALPHA). Testing
stops at the first cutoff that is not rejected (fixed sequence, so the walk itself costs
nothing), and the level is ``DELTA`` divided by rules times strata (Bonferroni). With
probability 1 - DELTA no stratum then loses more than ``ALPHA`` of its good documents to any
rule. Among certified cutoffs the one with the best gain is used: share of bad documents
rejected less ``PENALTY`` times the share of good ones, the mildest on ties, none if no gain.

A document goes if any rule fires, so up to ``len(RULES) * ALPHA`` of a stratum's good documents may
go in all, and copies of one labelled text count as so many draws. ``together`` certifies the
verdict instead: each rule at ``ALPHA / len(RULES)``, so that all rules lose no more than ``ALPHA``,
and one draw per stratum and distinct text; texts whose copies' labels disagree are ignored.

All of it is DataFrame expressions: one pass measures the documents, labels meet a narrow table
of shares, and the shuffle carries one row per stratum, label and task.

Defined results: a null text has no words and fails the base rule; documents of a stratum
without certified cutoffs (also a null stratum, which is one of its own) are kept unless the
base rule fails; labels of a document that disagree are ignored, repeated ones count once;
repeated rows get the same verdict; empty tables give empty tables.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.shared import Tables

ALPHA = 0.025
DELTA = 0.1
PENALTY = 5.0
CUTOFFS = (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05)
RULES = ("symbols", "upper", "lines", "repeats")
MIN_WORDS = 50

# White space that parts words, and symbols.
GAP = r"[\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
UPPER = r"\p{Lu}"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _occurrences(pattern: str) -> Column:
    """How often a single character of the pattern occurs in the text."""
    return F.size(F.split("_body", pattern)).cast("long") - 1


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with struct ``measures`` of the base counts and the four shares.

    ``n_repeat_words`` counts the words that lie in a window of three words found twice or more
    in the text. Windows are compared by 64-bit hashes: first all of them for repeats, and only
    texts that have some sort them with their places.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    step = docs.withColumns(
        {"_body": body, "_words": F.array_remove(F.split(body, GAP), "")}
    ).withColumn("_n", F.size("_words").cast("long"))
    window = F.transform(
        F.sequence(F.lit(0), (F.col("_n") - 3).cast("int")),
        lambda i: F.xxhash64(*[F.get(F.col("_words"), i + j) for j in range(3)]),
    )
    step = step.withColumn("_hashes", F.when(F.col("_n") >= 3, window))
    repeated = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    placed = F.sort_array(
        F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    )
    step = step.withColumn("_placed", F.when(repeated, placed))

    def twice(x: Column, k: Column) -> Column:
        before = F.get(F.col("_placed"), k - 1)["h"].eqNullSafe(x["h"])
        return before | F.get(F.col("_placed"), k + 1)["h"].eqNullSafe(x["h"])

    places = F.sort_array(F.transform(F.filter("_placed", twice), lambda x: x["i"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda acc, p: F.struct(
            (acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n"), p.alias("last")
        ),
        lambda acc: acc["n"].cast("long"),
    )
    lines = F.filter(F.split("_body", "\n"), lambda x: x.rlike(WORD_CHAR))
    step = step.withColumns(
        {
            "_lines": lines,
            "_n_repeat": F.when(F.col("_placed").isNull(), F.lit(0).cast("long")).otherwise(covered),
            "_chars": F.char_length(F.array_join("_words", "")).cast("long"),
        }
    )
    n_lines = F.size("_lines").cast("long")
    step = step.withColumns(
        {
            "_symbols": _occurrences(SYMBOL),
            "_upper": _occurrences(UPPER),
            "_n_lines": n_lines,
            "_dup_lines": n_lines - F.size(F.array_distinct("_lines")),
        }
    )

    def share(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)

    measures = F.struct(
        F.col("_n").alias("n_words"),
        F.col("_chars").alias("word_chars"),
        F.col("_symbols").alias("n_symbols"),
        F.col("_dup_lines").alias("n_dup_lines"),
        F.col("_n_repeat").alias("n_repeat_words"),
        share("_symbols", "_chars").alias("symbols"),
        share("_upper", "_chars").alias("upper"),
        share("_dup_lines", "_n_lines").alias("lines"),
        share("_n_repeat", "_n").alias("repeats"),
    )
    return step.select(*docs.columns, measures.alias("measures"))


def base_failed(measures: str = "measures") -> Column:
    m = F.col(measures)
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > 50 * m["n_words"])


def _log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x >= 1: Stirling's series at x + 7, carried back."""
    y = x + 7
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    back = F.lit(0.0)
    for j in range(7):
        back = back + F.log(x + j)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - back


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Bin(n, p), exact to rounding; 1 where k >= n p (then it is over 0.4).

    Below the mean the terms fall off from k downwards, so those more than twelve standard
    deviations below k are nothing at double precision and need not be summed.
    """
    reach = F.ceil(12 * F.sqrt(n * p)).cast("long") + 20
    choose = _log_gamma(n.cast("double") + 1)

    def term(j: Column) -> Column:
        x, rest = j.cast("double"), (n - j).cast("double")
        logs = choose - _log_gamma(x + 1) - _log_gamma(rest + 1)
        return F.exp(logs + x * math.log(p) + rest * math.log1p(-p))

    terms = F.transform(F.sequence(F.greatest(F.lit(0).cast("long"), k - reach), k), term)
    total = F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)
    return F.when(k >= n * p, 1.0).otherwise(total)


def clean_labels(labels: DataFrame, label: str = "quality") -> DataFrame:
    """``(doc_id, good)``: one row per document whose labels agree."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    agreed = rows.groupBy(F.col("doc_id").alias("_doc")).agg(
        F.min(label).alias("_lo"), F.max(label).alias("_hi")
    )
    return agreed.where("_lo = _hi").select("_doc", (F.col("_lo") == 1).alias("good"))


def certify(shares: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """``(stratum, symbols, upper, lines, repeats)``: the cutoff in use, NULL for none.

    ``shares`` is ``(stratum, good, symbols, upper, lines, repeats)``, one row per labelled
    document. Counts per cutoff are sums in one grouping, combined before the shuffle. No rule
    loses more than ``alpha``.
    """
    above = [
        F.sum(F.when(F.col(r) > c, 1).otherwise(0)).alias(f"{r}_{i}")
        for r in RULES
        for i, c in enumerate(CUTOFFS)
    ]
    counts = shares.groupBy("stratum", "good").agg(F.count(F.lit(1)).alias("n"), *above)
    cells = F.array(
        *[
            F.struct(
                F.lit(r).alias("rule"),
                F.lit(i).alias("at"),
                F.lit(c).alias("cutoff"),
                F.col(f"{r}_{i}").alias("hit"),
            )
            for r in RULES
            for i, c in enumerate(CUTOFFS)
        ]
    )
    long = counts.select("stratum", "good", "n", F.inline(cells))

    def of(good: bool, what: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("good") == good, F.col(what))), F.lit(0))

    grid = long.groupBy("stratum", "rule", "at", "cutoff").agg(
        of(True, "n").alias("good"),
        of(True, "hit").alias("lost"),
        of(False, "n").alias("bad"),
        of(False, "hit").alias("caught"),
    )
    # One grid of a dozen cutoffs per group, whatever the number of documents.
    walk = Window.partitionBy("stratum", "rule").orderBy("at")
    strata = F.max("_rank").over(Window.partitionBy("rule"))
    grid = grid.withColumn("_rank", F.dense_rank().over(Window.partitionBy("rule").orderBy("stratum")))
    level = DELTA / (len(RULES) * strata)
    tested = grid.withColumn("_ok", binomial_tail(F.col("lost"), F.col("good"), alpha) <= level)
    certified = tested.withColumn("_all", F.min("_ok").over(walk)).where("_all")
    gain = F.try_divide("caught", "bad") - PENALTY * F.col("lost") / F.col("good")
    best = (
        certified.withColumn("gain", gain)
        .where("gain > 0")
        .groupBy("stratum", "rule")
        .agg(F.max(F.struct("gain", -F.col("at"), "cutoff"))["cutoff"].alias("cutoff"))
    )
    return best.groupBy("stratum").agg(
        *[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(r) for r in RULES]
    )


def _verdict(rows: DataFrame, cutoffs: DataFrame, stratum: str) -> DataFrame:
    """``rows`` with ``kept``; a table of one row per stratum is joined by its measured size."""
    limits = cutoffs.select(
        F.col("stratum").alias("_stratum"), F.struct(*RULES).alias("_limits")
    )
    joined = rows.join(limits, F.col(stratum).eqNullSafe(F.col("_stratum")), "left")
    over = F.lit(False)
    for r in RULES:
        over = over | F.coalesce(F.col("measures")[r] > F.col("_limits")[r], F.lit(False))
    # As one sum the verdict needs both sides of the join. Split in two, its first half would be
    # pushed below the measures, which would then be computed anew for every word of a text.
    faults = base_failed().cast("int") + over.cast("int")
    return joined.withColumn("kept", faults == 0).drop("_stratum", "_limits")


def learn_cutoffs(
    measures: DataFrame, labels: DataFrame, tables: Tables, together: bool = False
) -> DataFrame:
    """The certified cutoffs, as a written table, from ``(doc_id, stratum, measures)``.

    ``together`` needs the texts' hashes too, as ``mark``.
    """
    labelled = measures.join(clean_labels(labels), F.col("doc_id") == F.col("_doc"))
    of_rules = [F.col("measures")[r].alias(r) for r in RULES]
    if not together:
        return tables.cut(certify(labelled.select("stratum", "good", *of_rules)), "cutoffs")
    draws = labelled.select("stratum", "mark", "good", *of_rules).groupBy("stratum", "mark").agg(
        F.min("good").alias("good"), F.max("good").alias("_hi"), *[F.max(r).alias(r) for r in RULES]
    )
    draws = draws.where("good = _hi").select("stratum", "good", *RULES)
    return tables.cut(certify(draws, ALPHA / len(RULES)), "cutoffs")


def _measures(docs: DataFrame, stratum: str, *marks: Column) -> DataFrame:
    narrow = docs.select("doc_id", F.col(stratum).alias("stratum"), *marks, "text")
    return measured(narrow).drop("text")


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """``(doc_id, stratum, measures, base_failed, kept)`` for every row of ``docs``.

    The texts are read once: their measures are written, then used to certify and to judge.
    """
    tables = Tables(docs.sparkSession)
    measures = tables.cut(_measures(docs, stratum), "measures")
    cutoffs = learn_cutoffs(measures, labels, tables)
    return _verdict(measures, cutoffs, "stratum").withColumn("base_failed", base_failed())


def keep_good(
    docs: DataFrame, labels: DataFrame, stratum: str = "lang", together: bool = False
) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns as they came.

    Rows need no identity for this: cutoffs are learned from a narrow pass, then each row is
    judged where it is read, so texts are never shuffled.
    """
    tables = Tables(docs.sparkSession)
    marks = [F.xxhash64("text").alias("mark")] if together else []
    measures = tables.cut(_measures(docs, stratum, *marks), "measures")
    cutoffs = learn_cutoffs(measures, labels, tables, together)
    tables.drop(measures)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(stratum).alias("_of"),
        F.col("text").alias("_text"),
    )
    return _verdict(measured(rows, "_text"), cutoffs, "_of").where("kept").select("row.*")
