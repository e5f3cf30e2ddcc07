"""Benchmark decontamination by templates.

Texts become token sequences in which numbers, names and units are slots: the token keeps its value behind a marker,
the template keeps the marker alone. Windows of ``width`` template tokens are hashed and equi-joined with those of
the benchmark items, so a question whose numbers or names were changed still meets its item. Windows are counted along a
diagonal (document place minus item place), and along it with the ``width`` diagonals after it, as a longer name or an
inserted word moves the rest. If each value of the item stands for one value of the document there, a document is
contaminated if the windows cover at least ``min_share`` of the item's tokens or ``min_run`` tokens. If some value
stands for two, only windows count whose slots all are equal or all have the commonest document value, and they must
cover ``min_run`` tokens that are no slots. Items shorter than a window are
matched whole. The template of a window in which less than half of the tokens are literal tells nothing, so such windows
are matched by the values of their slots as well, that is as exact copies. An item's first token is read both as the start of
a text and as the middle of one, as it may be a name or a unit there.

Numbers are digits with separators; units are the words of UNITS right after a number; names are capitalised words in
the middle of a sentence. The characters U+0001 to U+0003 in a text act as slots themselves. Null, empty and blank texts match nothing, and an item without tokens matches no document.
Repeated items or documents give results for each id once. Null ids of documents match like any other; empty
tables give empty results; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from plumbline.llm.common import fresh, save, with_window_hashes

# fixed values: unit words that follow a number
UNITS = ["km", "m", "cm", "mm", "kg", "g", "mg", "lb", "lbs", "oz", "mph", "kmh", "l", "ml", "percent", "usd", "eur", "dollars", "euros",
         "cents", "miles", "feet", "inches", "meters", "metres", "hours", "minutes", "seconds", "days", "weeks", "months", "years"]
NUMBER, NAME, UNIT = "\x01", "\x02", "\x03"
FILTER_BITS = 17


def with_template(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``_tokens``, lower-case with slots that begin with their marker, and ``_template``.

    The costlier patterns run only on texts that have a number.
    """
    body = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"\p{Lu}(?<=[\p{L}\p{N},;] \p{Lu})(?=\p{Ll})", NAME + "$0")
    number = r"[0-9](?<![\p{L}\p{N}\x02][0-9])(?<![0-9][.,][0-9])(?=[0-9.,]*(?![\p{L}0-9]))"
    unit = r"(?<=[0-9] ?)(?:" + "|".join(sorted(UNITS, key=len, reverse=True)) + r")(?![\p{L}\p{N}])"
    between = r"(?:[^\p{L}\p{N}\x01-\x03.,]|[.,](?![0-9])|(?<![0-9])[.,])+"
    df = df.withColumn("_body", F.regexp_replace(F.lower(body), number, NUMBER + "$0"))
    slots = F.contains("_body", F.lit(NUMBER)) | F.contains("_body", F.lit(NAME)) | F.contains("_body", F.lit(UNIT))
    parts = F.when(F.contains("_body", F.lit(NUMBER)), F.split(F.regexp_replace("_body", unit, " " + UNIT + "$0"), between)).otherwise(
        F.split("_body", r"[^\p{L}\p{N}\x01-\x03]+"))
    df = df.withColumn("_tokens", F.array_remove(parts, "")).withColumn("_slots", slots)
    marked = F.transform("_tokens", lambda t: F.when(t < "\x04", F.substring(t, 1, 1)).otherwise(t))
    return df.withColumn("_template", F.when(F.col("_slots"), marked).otherwise(F.col("_tokens"))).drop("_body", "_slots")


def _windows(df: DataFrame, width: int) -> DataFrame:
    return with_window_hashes(df, "_template", width, "_windows")


def benchmark_windows(benchmark: DataFrame, width: int) -> DataFrame:
    """item_id, n_item, width, ipos, hash, key, islots, iat: windows of the items; ``islots`` are the slots inside, ``iat`` their places."""
    texts = benchmark.select("item_id", "text").filter("item_id is not null and text is not null").distinct()
    alone = with_template(texts)
    # after a number the first word is a unit or a name if it can be one; the number itself goes again
    within = with_template(texts.withColumn("text", F.concat(F.lit("1 "), "text")))
    within = within.withColumns({c: F.expr(f"slice({c}, 2, greatest(size({c}) - 1, 0))") for c in ("_tokens", "_template")})
    items = alone.unionByName(within).withColumn("n_item", F.size("_tokens")).filter("n_item > 0")
    items = save(items.drop("text").distinct(), "benchmark-tokens")
    shorter = sorted(r[0] for r in items.filter(F.col("n_item") < width).select("n_item").distinct().collect())
    out = None
    for size in [*shorter, width]:
        own = items.filter((F.col("n_item") == size) if size < width else (F.col("n_item") >= size))
        own = _windows(own, size).select("item_id", "n_item", "_tokens", F.lit(size).alias("width"), F.posexplode_outer("_windows").alias("ipos", "hash"))
        own = own.withColumn("part", F.slice("_tokens", F.col("ipos") + 1, size))
        own = own.withColumn("islots", F.filter("part", lambda t: t < "\x04"))
        own = own.withColumn("iat", F.filter(F.transform("part", lambda t, i: F.when(t < "\x04", F.col("ipos") + i)), lambda i: i.isNotNull()))
        own = own.select("item_id", "n_item", "width", "ipos", "hash", "islots", "iat")
        out = own if out is None else out.unionByName(own)
    return save(out, "benchmark-windows").filter("hash is not null").withColumn("key", _key("islots", F.col("width"))).distinct()


def _key(slots: str, width: Column) -> Column:
    """What windows are joined by: the template's hash, with the values of the slots where these are more than half."""
    return F.when(F.size(slots) * 2 > width, F.xxhash64("hash", slots)).otherwise(F.col("hash"))


def _bits(windows: DataFrame, column: str) -> Column:
    """A constant bitmap of the item windows' hashes, 2^17 bits whatever their number: it spares rows, never decides."""
    at = F.pmod(column, F.lit(1 << FILTER_BITS))
    words = windows.groupBy(F.floor(at / 64).cast("int").alias("w")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(64)).cast("int"))).alias("b"))
    bitmap = [0] * (1 << (FILTER_BITS - 6))
    for r in words.collect():
        bitmap[r["w"]] = r["b"]
    return F.lit(np.array(bitmap, dtype=np.int64))


def _in(bitmap: Column, value: Column) -> Column:
    at = F.pmod(value, F.lit(1 << FILTER_BITS))
    return F.call_function("shiftright", F.get(bitmap, F.floor(at / 64).cast("int")), F.pmod(at, F.lit(64)).cast("int")).bitwiseAND(1) == 1


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, width: int = 8, min_share: float = 0.5, min_run: int = 16) -> DataFrame:
    """doc_id, h (hash of the text), item_id, diagonal, n_item, covered, slots: one row for each document and item."""
    windows = benchmark_windows(benchmark, width)
    sizes = sorted(r[0] for r in windows.select("width").distinct().collect())  # at most ``width`` numbers
    texts = with_template(docs.select("doc_id", "text").filter("text is not null")).withColumn("h", F.xxhash64("text")).drop("text")
    hits = None
    # the outer forms of explode: the others add a filter that repeats the arrays' expressions inside each other
    for size in sizes:
        own = windows.filter(F.col("width") == size)
        bitmap, keys = _bits(own, "hash"), _bits(own, "key")
        rows = _windows(texts, size)
        found = F.filter(F.sequence(F.lit(0), F.size("_windows") - 1), lambda i: _in(bitmap, F.get("_windows", i)))
        rows = rows.withColumn("_found", F.when(F.size("_windows") > 0, found))
        rows = rows.select("doc_id", "h", F.explode_outer(F.transform("_found", lambda i: F.struct(
            i.alias("pos"), F.get("_windows", i).alias("hash"),
            F.filter(F.slice("_tokens", i + 1, size), lambda t: t < "\x04").alias("slots")))).alias("x")).select("doc_id", "h", "x.*")
        rows = rows.filter("hash is not null").withColumn("width", F.lit(size)).withColumn("key", _key("slots", F.lit(size)))
        rows = rows.filter(_in(keys, F.col("key"))).drop("hash")
        hits = rows if hits is None else hits.unionByName(rows)
    if hits is None:
        kinds = [docs.schema["doc_id"], T.StructField("h", T.LongType()), windows.schema["item_id"], T.StructField("diagonal", T.IntegerType()),
                 windows.schema["n_item"], T.StructField("covered", T.IntegerType()), T.StructField("slots", T.IntegerType())]
        return docs.sparkSession.createDataFrame([], T.StructType(kinds))
    hits = save(hits, "decontamination-hits").distinct()
    matched = hits.join(windows.drop("hash"), ["width", "key"]).withColumn("diagonal", F.col("pos") - F.col("ipos"))
    matched = matched.filter(F.size("slots") == F.size("islots"))
    pair = ["doc_id", "h", "item_id"]
    lane = [*pair, "n_item", "width"]
    pairs = F.when(F.size("islots") * 2 > F.col("width"), F.array().cast("array<struct<islots:string,slots:string>>")).otherwise(F.arrays_zip("islots", "slots"))
    # on one diagonal there are at most as many windows as the item has tokens; one exchange serves all groups
    lanes = (matched.select(*lane, "diagonal", F.struct("ipos", "iat", pairs.alias("map")).alias("w")).repartition(*pair)
             .groupBy(*lane, "diagonal").agg(F.collect_set("w").alias("own")))
    near = Window.partitionBy(*lane).orderBy("diagonal").rangeBetween(0, width)
    lanes = lanes.withColumn("band", F.flatten(F.collect_list("own").over(near)))
    for name in ("own", "band"):
        lanes = lanes.withColumn(f"{name}_map", F.array_distinct(F.flatten(F.transform(name, lambda w: w["map"]))))
        lanes = lanes.withColumn(f"{name}_at", F.array_sort(F.array_distinct(F.transform(name, lambda w: w["ipos"]))))
        n = F.aggregate(f"{name}_at", F.struct(F.lit(0).alias("n"), F.lit(-1_000_000).alias("last")), lambda a, p: F.struct(
            (a["n"] + F.least(F.col("width"), p - a["last"])).alias("n"), p.alias("last")))["n"]
        single = F.size(f"{name}_map") == F.size(F.array_distinct(F.transform(f"{name}_map", lambda x: x["islots"])))
        enough = (n >= F.col("n_item") * min_share) | (n >= min_run)
        lanes = lanes.withColumn(f"{name}_n", F.when(single & enough, n)).drop(f"{name}_at")
    conflict = F.size("band_map") > F.size(F.array_distinct(F.transform("band_map", lambda x: x["islots"])))
    lanes = lanes.withColumn("votes", F.when(conflict, F.flatten(F.transform("band", lambda w: w["map"]))))
    commonest = F.transform(F.array_distinct(F.transform("votes", lambda x: x["islots"])), lambda v: F.array_max(F.transform(
        F.filter("band_map", lambda x: x["islots"] == v),
        lambda c: F.struct(F.size(F.filter("votes", lambda x: x == c)).alias("n"), c.alias("pair"))))["pair"])
    lanes = lanes.withColumn("chosen", commonest)
    lanes = lanes.withColumn("kept", F.when(conflict, F.filter("band", lambda w: F.forall(w["map"], lambda x: x["islots"] == x["slots"])
                                                               | F.forall(w["map"], lambda x: F.array_contains("chosen", x)))))
    lanes = lanes.withColumn("places", F.array_distinct(F.flatten(F.transform("kept", lambda w: F.sequence(w["ipos"], w["ipos"] + F.col("width") - 1)))))
    lanes = lanes.withColumn("literal", F.size(F.array_except("places", F.flatten(F.transform("kept", lambda w: w["iat"])))))
    lanes = lanes.withColumn("covered", F.greatest("own_n", "band_n", F.when(conflict & (F.col("literal") >= min_run), F.size("places"))))
    lanes = lanes.filter("covered is not null")
    best = F.max_by(F.struct("diagonal", "n_item", "covered", F.size("band_map").alias("slots")), F.struct("covered", -F.col("diagonal")))
    return lanes.groupBy(*pair).agg(best.alias("b")).select(*pair, "b.*")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """The documents that no item contaminates, with all their columns."""
    doc, h = fresh(docs.columns, "_doc"), fresh(docs.columns, "_h")
    bad = contaminated_pairs(docs, benchmark, **parameters).select(F.col("doc_id").alias(doc), F.col("h").alias(h)).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(F.col(doc)) & (F.xxhash64(docs["text"]) == F.col(h)), "left_anti")
