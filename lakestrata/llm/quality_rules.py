"""Quality rules with risk-controlled thresholds, in DataFrame functions alone.

Every rule compares one metric of a text with a cutoff. Cutoffs come from labelled holdouts: per
stratum and metric the strictest one whose false rejection rate is below the allowed risk, by an
exact binomial test on the good documents it would reject.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.names import apart
from lakestrata.session import new_scratch

WORD_GAP = r"[\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"
NOT_SYMBOL = r"[^#*$%&|<>]+"
MIN_WORDS = 50
RISK = 0.02
CONFIDENCE = 0.95

#: Cutoffs tried per metric, most lenient first, down to none at all; a document is rejected above
#: its cutoff. How far down they go is up to the test alone.
SHARES = tuple(round(0.95 - 0.05 * i, 2) for i in range(19)) + (0.04, 0.03, 0.02, 0.01, 0.0)
GRIDS: Mapping[str, Sequence[float]] = {
    "symbol_share": SHARES,
    "dup_line_share": SHARES,
    "repeat_word_share": SHARES,
    "capital_share": SHARES,
    "bang_share": SHARES,
    "same_word_share": SHARES,
}


def _pack(window: Column, place: Column) -> Column:
    """The window hash above the place, in one long."""
    return F.call_function("shiftleft", window, F.col("_bits")).bitwiseOR(place.cast("long"))


def _hash_of(packed: Column) -> Column:
    return F.call_function("shiftright", packed, F.col("_bits"))


def _place_of(packed: Column) -> Column:
    return packed.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_bits")) - 1)


def text_features(documents: DataFrame, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns, the base counts, ``base_failed`` and the metrics of every text.

    ``same_word_share`` counts words equal to the one before, so it does not grow with a text's length. NULL is an empty text. Repeated windows are found by sorting (window hash, place) pairs packed
    into one long per word: the place takes as many low bits as the text needs. Windows that share
    what is left of their hashes are then sorted by their words, and only equal words count.
    """
    base = documents.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    cut = base.withColumn("_words", F.filter(F.split("_text", WORD_GAP), lambda w: w != "")).withColumn(
        "_lines", F.filter(F.split("_text", "\n"), lambda line: line.rlike(WORD_CHAR))
    )
    counted = (
        cut.withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("_bits", F.ceil(F.log2(F.col("n_words") + 1)).cast("int"))
        .withColumn("_joined", F.array_join("_words", ""))
    )
    place = F.sequence(F.lit(1), (F.col("n_words") - 2).cast("int"))
    window = lambda i: F.xxhash64(F.get("_words", i - 1), F.get("_words", i), F.get("_words", i + 1))
    hashed = counted.withColumn(
        "_sorted",
        F.when(F.col("n_words") >= 3, F.sort_array(F.transform(place, lambda i: _pack(window(i), i)))).otherwise(F.array().cast("array<bigint>")),
    )
    at = lambda j: F.get("_sorted", j)
    same = lambda x, y: F.coalesce(_hash_of(x) == _hash_of(y), F.lit(False))
    word = lambda i: F.get("_words", i.cast("int"))
    alike = hashed.withColumn(
        "_alike",
        F.sort_array(
            F.transform(
                F.transform(F.filter("_sorted", lambda x, j: same(x, at(j - 1)) | same(x, at(j + 1))), _place_of),
                lambda i: F.struct(F.struct(word(i - 1).alias("a"), word(i).alias("b"), word(i + 1).alias("c")).alias("words"), i.alias("place")),
            )
        ),
    )
    by = lambda j: F.get("_alike", j)["words"]
    equal = lambda x, y: F.coalesce(x == y, F.lit(False))
    repeated = alike.withColumn(
        "_places",
        F.sort_array(
            F.transform(
                F.filter("_alike", lambda x, j: equal(x["words"], by(j - 1)) | equal(x["words"], by(j + 1))),
                lambda x: x["place"],
            )
        ),
    )
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    return (
        repeated.select(
            *keep,
            "n_words",
            F.length("_joined").cast("long").alias("word_chars"),
            F.length(F.regexp_replace("_joined", NOT_SYMBOL, "")).cast("long").alias("n_symbols"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            F.aggregate(
                F.transform("_places", lambda p, j: F.when(j == 0, F.lit(3).cast("long")).otherwise(F.least(F.lit(3).cast("long"), p - F.get("_places", j - 1)))),
                F.lit(0).cast("long"),
                lambda total, covered: total + covered,
            ).alias("n_repeat_words"),
            F.size("_lines").alias("_n_lines"),
            F.length(F.regexp_replace("_joined", r"[^\p{Lu}]+", "")).alias("_capitals"),
            F.length(F.regexp_replace("_joined", r"[^!]+", "")).alias("_bangs"),
            F.size(F.filter("_words", lambda w, i: F.coalesce(w == F.get("_words", i - 1), F.lit(False)))).alias("_n_same"),
        )
        .withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
        .withColumn("symbol_share", F.col("n_symbols") / chars)
        .withColumn("dup_line_share", F.col("n_dup_lines") / F.greatest(F.col("_n_lines"), F.lit(1)))
        .withColumn("repeat_word_share", F.col("n_repeat_words") / words)
        .withColumn("capital_share", F.col("_capitals") / chars)
        .withColumn("bang_share", F.col("_bangs") / chars)
        .withColumn("same_word_share", F.col("_n_same") / words)
        .drop("_n_lines", "_capitals", "_bangs", "_n_same")
    )


def _binomial_tail(rejected: Column, good: Column, risk: float) -> Column:
    """P(X <= rejected) for X ~ Bin(good, risk): the exact p-value of "the rate is at least risk".

    Terms are summed from the first one up, relative to the running largest, so nothing underflows.
    """
    odds = risk / (1 - risk)

    def step(state: Column, i: Column) -> Column:
        term = state["term"] + F.log((good - i + 1) / i * odds)
        top = F.greatest(state["top"], term)
        return F.struct(term.alias("term"), top.alias("top"), (state["sum"] * F.exp(state["top"] - top) + F.exp(term - top)).alias("sum"))

    first = good * F.log(F.lit(1 - risk))
    start = F.struct(first.alias("term"), first.alias("top"), F.lit(1.0).alias("sum"))
    counts = F.when(rejected > 0, F.sequence(F.lit(1).cast("long"), rejected.cast("long"))).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(counts, start, step, lambda s: F.exp(s["top"]) * s["sum"])


def risk_controlled_cutoffs(
    good: DataFrame,
    stratum: str,
    grids: Mapping[str, Sequence[float]] = GRIDS,
    risk: float = RISK,
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """``(stratum, metric, good, cutoff)``: the strictest safe cutoff per stratum and metric.

    ``good`` holds the metrics of labelled good documents. ``risk`` bounds the share of good
    documents that a stratum's rules reject together: each metric gets an equal part of it. All
    bounds hold at once with ``confidence``: its complement is shared out equally over strata and
    metrics (Bonferroni), and within a metric cutoffs are tested in a fixed order, most lenient
    first, up to the first that fails, which needs no correction. A stratum with too few good
    documents to prove anything has a NULL cutoff and rejects nothing.
    """
    share = risk / len(grids)
    levels = F.array(*(F.struct(F.lit(name).alias("metric"), F.col(name).alias("value")) for name in grids))
    seen = good.select(F.col(stratum).alias("stratum"), F.explode(levels).alias("_m")).select("stratum", "_m.metric", "_m.value")
    steps = F.create_map(*(x for name, grid in grids.items() for x in (F.lit(name), F.array(*(F.lit(float(c)) for c in grid)))))
    # of every document the first cutoff, in order of strictness, that rejects it
    first = F.size(F.filter(F.element_at(steps, F.col("metric")), lambda c: c >= F.col("value")))
    held = seen.groupBy("stratum", "metric", first.alias("step")).agg(F.count(F.lit(1)).alias("n"))
    # one small row per (stratum, metric): its counts by step, at most one per cutoff
    groups = held.groupBy("stratum", "metric").agg(
        F.sum("n").alias("good"), F.map_from_entries(F.collect_list(F.struct("step", "n"))).alias("by_step")
    )
    strata = good.select(stratum).distinct().count()
    tried = groups.select(
        "stratum", "metric", "good", "by_step", F.posexplode(F.element_at(steps, F.col("metric"))).alias("step", "cutoff")
    )
    rejected = F.aggregate(
        F.map_entries("by_step"),
        F.lit(0).cast("long"),
        lambda total, e: total + F.when(e["key"] <= F.col("step"), e["value"]).otherwise(0),
    )
    # beyond the mean the p-value exceeds a half, so the sum need not be taken
    p = F.when(F.col("rejected") <= share * F.col("good"), _binomial_tail(F.col("rejected"), F.col("good"), share)).otherwise(1.0)
    allowed = (1 - confidence) / (max(strata, 1) * len(grids))
    tested = tried.withColumn("rejected", rejected).withColumn("safe", p <= allowed)
    return tested.groupBy("stratum", "metric", "good").agg(
        F.min(F.when(~F.col("safe"), F.col("step"))).alias("_failed"),
        F.sort_array(F.collect_list(F.struct("step", "cutoff"))).alias("_tried"),
    ).select(
        "stratum",
        "metric",
        "good",
        F.get("_tried", F.coalesce("_failed", F.size("_tried")) - 1)["cutoff"].alias("cutoff"),
    )


def _judged(documents: DataFrame, labels: DataFrame, key: str, text: str, stratum: str, label: str, risk: float, confidence: float) -> DataFrame:
    """Counts and verdict of every row as ``(key, stratum, _version, ...)``; ``_version`` is the text's hash."""
    spark = documents.sparkSession
    path = new_scratch(spark, "features")
    rows = documents.select(
        key, F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("_stratum"), version_of(text).alias("_version"), F.col(text).alias("_whole")
    )
    features = text_features(rows, "_whole", [key, "_stratum", "_version"])
    features.write.parquet(path)
    stored = spark.read.schema(features.schema).parquet(path)
    good = labels.filter(F.col(label) == 1).select(F.col(key).alias("_good")).distinct()
    holdout = stored.filter(~F.col("base_failed")).join(good, stored[key] == good["_good"], "left_semi")
    cutoffs = risk_controlled_cutoffs(holdout, "_stratum", GRIDS, risk, confidence).groupBy(F.col("stratum").alias("_stratum")).agg(
        F.map_from_entries(F.collect_list(F.struct("metric", "cutoff"))).alias("_cutoffs")
    )
    judged = stored.join(cutoffs, "_stratum", "left")
    bad = F.lit(False)
    for metric in GRIDS:
        bad = bad | F.coalesce(F.col(metric) > F.element_at("_cutoffs", F.lit(metric)), F.lit(False))
    return judged.withColumn("kept", ~F.col("base_failed") & ~bad).drop("_cutoffs")


def version_of(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def judge_documents(
    documents: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    stratum: str = "lang",
    label: str = "quality",
    risk: float = RISK,
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """Every document as ``(key, counts, metrics, base_failed, kept, stratum)``.

    ``kept`` is false for a base failure, and where a metric exceeds its stratum's cutoff. Labels
    with another value than 0 or 1, of unknown or NULL keys are ignored; a key labelled both ways
    counts as good once. Repeated documents stay; NULL strata are the stratum ``""``, NULL texts
    empty. Counts are written once to the shared scratch folder, for both cutoffs and verdicts.
    """
    judged = _judged(documents, labels, key, text, stratum, label, risk, confidence)
    return judged.drop("_version").withColumnRenamed("_stratum", "stratum")


def keep_documents(
    documents: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    stratum: str = "lang",
    label: str = "quality",
    risk: float = RISK,
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """The rows of ``documents`` that ``judge_documents`` keeps; same columns, whatever their names."""
    docs, (key_, text_, stratum_) = apart(documents, key, text, stratum)
    known = labels.select(F.col(key).alias(key_), F.col(label).alias("label"))
    judged = _judged(docs, known, key_, text_, stratum_, "label", risk, confidence)
    gone = judged.filter("not kept").select(F.col(key_).alias("_gone"), F.col("_version").alias("_gone_version")).distinct()
    same = F.col(key_).eqNullSafe(F.col("_gone")) & (version_of(text_) == F.col("_gone_version"))
    return docs.join(gone, same, "left_anti").toDF(*documents.columns)
