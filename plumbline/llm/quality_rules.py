"""Quality rules whose cut-offs adapt to language and source.

Every document gets metrics. Per (lang, source) a mergeable quantile sketch of each metric is kept: counts of
buckets that each are ACCURACY wide in proportion to their values and have no end, so any quantile is known to half of that,
however large. Sketches merge by adding counts, so a small group falls back to the
merged sketch of its language, and that to the one of all rows. A document fails a rule if its metric itself lies above
the upper fence ``q75 + factor * max(q75 - q25, least_spread)`` of its group. Fences are joined to the documents. There are no
lower fences: for every metric here little of it (few symbols, few repeats, short words) is no fault of a text.
The sketch does not depend on the order in which rows arrive, so results repeat exactly.

Null or blank text: no words, all counts 0, ``base_failed``. Null lang or source: a group like any other. Repeated
rows give repeated results; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.llm.common import BLANKS, count_of, save, with_window_hashes, words_of

SYMBOLS = "#*$%&|<>"
SHOUTS = "A-Z!"
#: width of a bucket in proportion to its values, and the bucket of zero
ACCURACY = 0.02
ZERO = -(2 ** 31)
#: metric: least spread in its unit (thousandths; letters in a hundred words for word_length)
METRICS = {"symbols": 5, "shouts": 10, "repeats": 50, "dup_lines": 75, "word_length": 30}


def with_statistics(docs: DataFrame, text: str = "text", width: int = 8) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_shouts, n_lines, n_dup_lines and n_repeat_words."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    step = (docs
            .withColumn("_words", words_of(F.col(text)))
            .withColumn("_lines", lines)
            .withColumn("n_words", F.size("_words").cast("long"))
            .withColumn("word_chars", (F.length(body) - count_of(body, "\\x20\\x09-\\x0D")).cast("long"))
            .withColumn("n_symbols", count_of(body, SYMBOLS).cast("long"))
            .withColumn("n_shouts", count_of(body, SHOUTS).cast("long"))
            .withColumn("n_lines", F.size("_lines").cast("long"))
            .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long")))
    step = with_window_hashes(step, "_words", width, "_windows")
    # only texts with an equal pair of windows need their places: sorted by hash, equal ones are neighbours
    repeated = F.size(F.array_distinct("_windows")) < F.size("_windows")
    step = step.withColumn("_sorted", F.when(repeated, F.array_sort(F.transform(
        "_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    at = F.transform("_sorted", lambda x, j: F.when(
        (F.get("_sorted", j - 1)["h"] == x["h"]) | (F.get("_sorted", j + 1)["h"] == x["h"]), x["i"]))
    step = step.withColumn("_places", F.array_sort(F.filter(at, lambda p: p.isNotNull())))
    covered = F.aggregate(
        "_places", F.struct(F.lit(0).alias("n"), F.lit(-width).alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(width), p - a["last"])).alias("n"), p.alias("last")))["n"]
    step = step.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    return step.drop("_words", "_lines", "_windows", "_sorted", "_places")


def _scaled(part: str, whole: str, unit: int) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) * unit / F.col(whole)).otherwise(F.lit(0.0))


def bucket_of(value: Column) -> Column:
    """The sketch's bucket of a value that is not negative."""
    return F.when(value > 0, F.ceil(F.log(value) / math.log(1 + ACCURACY)).cast("int")).otherwise(F.lit(ZERO))


def value_of(bucket: Column) -> Column:
    """The middle of a bucket."""
    return F.when(bucket == ZERO, F.lit(0.0)).otherwise(F.pow(F.lit(1 + ACCURACY), bucket) * (2 / (2 + ACCURACY)))


def metrics() -> dict[str, Column]:
    return {"symbols": _scaled("n_symbols", "word_chars", 1000), "shouts": _scaled("n_shouts", "word_chars", 1000),
            "repeats": _scaled("n_repeat_words", "n_words", 1000), "dup_lines": _scaled("n_dup_lines", "n_lines", 1000),
            "word_length": _scaled("word_chars", "n_words", 100)}


def sketches(stats: DataFrame, names: list[str]) -> DataFrame:
    """(lang, source, metric, bucket, n): a few thousand buckets a metric at most, made with map-side sums."""
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), bucket_of(F.col(m)).alias("bucket")) for m in names]))
    return (stats.select("lang", "source", pairs.alias("p")).select("lang", "source", "p.metric", "p.bucket")
            .groupBy("lang", "source", "metric", "bucket").agg(F.count("*").alias("n")))


def _quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """First buckets whose summed count reaches a quarter and three quarters of the rows."""
    merged = sketch.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "metric")
    ranked = (merged.withColumn("up_to", F.sum("n").over(group.orderBy("bucket")))
              .withColumn("rows", F.sum("n").over(group)))
    low, high = (F.min(F.when(F.col("up_to") * 4 >= F.col("rows") * k, F.col("bucket"))) for k in (1, 3))
    return ranked.groupBy(*keys, "metric").agg(value_of(low).alias("q1"), value_of(high).alias("q3"), F.max("rows").alias("rows"))


def fences(sketch: DataFrame, factor: int = 4, min_rows: int = 100) -> DataFrame:
    """(lang, source, <metric>_max...): the group's own fence, else its language's, else that of all rows."""
    levels = [_quartiles(sketch, keys) for keys in (["lang", "source"], ["lang"], [])]
    spread = F.create_map(*[F.lit(x) for pair in METRICS.items() for x in pair])[F.col("metric")]
    named = [q.select(*[c for c in ("lang", "source") if c in q.columns], "metric", F.col("rows").alias(f"rows{i}"),
                      (F.col("q3") + factor * F.greatest(F.col("q3") - F.col("q1"), spread)).alias(f"f{i}"))
             for i, q in enumerate(levels)]
    own = named[0]
    own = own.alias("o").join(named[1].alias("l"), F.col("o.lang").eqNullSafe(F.col("l.lang"))
                              & (F.col("o.metric") == F.col("l.metric")), "left").select("o.*", "l.rows1", "l.f1")
    own = own.join(named[2], "metric", "left")
    fence = F.when(F.col("rows0") >= min_rows, F.col("f0")).when(F.col("rows1") >= min_rows, F.col("f1")).otherwise(F.col("f2"))
    return own.groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("metric") == m, fence)).alias(f"{m}_max") for m in METRICS])


def apply_rules(docs: DataFrame, factor: int = 4, min_rows: int = 100, min_words: int = 20, max_repeat: int = 30) -> DataFrame:
    """doc_id, lang, source, the counts, base_failed, kept and the names of the rules that a document fails."""
    stats = with_statistics(docs.select("doc_id", "lang", "source", "text")).drop("text")
    # the texts are read once: sketch and filter both work on the saved numbers
    stats = save(stats.withColumns(metrics()), "quality-statistics")
    limits = fences(sketches(stats, list(METRICS)), factor, min_rows)
    limits = limits.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), *[f"{m}_max" for m in METRICS])
    joined = stats.join(limits, stats.lang.eqNullSafe(limits._lang) & stats.source.eqNullSafe(limits._source), "left")
    failed = F.filter(F.array(*[F.when(F.col(m) > F.col(f"{m}_max"), F.lit(m)) for m in METRICS]), lambda x: x.isNotNull())
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    return joined.select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         base.alias("base_failed"), failed.alias("failed_rules"),
                         (~base & (F.size(failed) == 0)).alias("kept"))
