"""Shards of near equal bytes by sampled splitters.

Records are ordered by a key: the hash of the text, then the id, so equal texts are neighbours and even a text that a
third of all rows share can be divided. A size-weighted sample of keys gives quantile boundaries, which cut the
order into many ranges; ranges that turn out overfull are sampled again and subdivided. Running sums of bytes inside a
range plus the totals of the ranges before it give each record its place in the whole order, and with it its
shard (equal parts of all bytes) and its slot (gapless within the shard). No range is larger than a few
hundredths of a shard, whatever the skew; only the boundaries and the totals of the ranges are ever held together.

Null text: no bytes, crc32 of the empty text. A null id sorts first. Equal rows (same id and text) are
interchangeable and get slots next to each other. An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.llm.common import save

OVERHEAD = 16
RANGES_A_SHARD = 16
SAMPLES_A_RANGE = 8
ROWS_A_RANGE = 2_000_000
LEAST_ID = -(2 ** 63)


def _range_of(bounds: list[tuple[int, int]]) -> Column:
    """Number of boundaries at or below a row's key, by binary search in two constant arrays."""
    if not bounds:
        return F.lit(0)
    high, low = (F.lit(np.array(x, dtype=np.int64)) for x in zip(*bounds))
    steps = [1 << k for k in range(len(bounds).bit_length() - 1, -1, -1)]

    def step(at: Column, size: Column) -> Column:
        h, i = F.get(high, at + size - 1), F.get(low, at + size - 1)
        return F.when((h < F.col("key")) | ((h == F.col("key")) & (i <= F.col("key_id"))), at + size).otherwise(at)

    return F.aggregate(F.lit(steps), F.lit(0), step)


def _sample(rows: DataFrame, rate: Column, wanted: int) -> list[tuple[int, int]]:
    """Every k-th key of a size-weighted sample, as boundaries. The draw is a hash of the key, so it repeats."""
    draw = F.pmod(F.xxhash64("key", "key_id", F.lit(11)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = rows.filter(draw < F.col("size") * rate).select("key", "key_id").distinct()
    keys = [(r[0], r[1]) for r in drawn.orderBy("key", "key_id").collect()]
    every = max(1, len(keys) // max(wanted, 1))
    return keys[every // 2::every]


def assign_shards(docs: DataFrame, shards: int = 40, rounds: int = 4) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot, and the range that the record fell into."""
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = save(docs.select(
        "doc_id", (F.octet_length(body) + OVERHEAD).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"),
        F.xxhash64(body).alias("key"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID)).alias("key_id")), "shard-rows")
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    wanted = max(shards * RANGES_A_SHARD, n // ROWS_A_RANGE)
    bounds = sorted(set(_sample(rows, F.lit(wanted * SAMPLES_A_RANGE / max(total, 1)), wanted)))
    for _ in range(rounds):
        sums = rows.groupBy(_range_of(bounds).alias("range")).agg(F.sum("size").alias("bytes"))
        full = {r["range"]: r["bytes"] for r in sums.filter(F.col("bytes") * wanted > 4 * total).collect()}
        if not full:
            break
        inside = rows.filter(_range_of(bounds).isin(list(full)))
        pieces = sum(full.values()) * wanted // max(total, 1)
        more = _sample(inside, F.lit(pieces * SAMPLES_A_RANGE / sum(full.values())), int(pieces))
        finer = sorted(set(bounds) | set(more))
        if finer == bounds:
            break  # what is left are single keys
        bounds = finer
    rows = rows.withColumn("range", _range_of(bounds))
    # totals of the ranges: as many rows as there are boundaries
    sums = rows.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("range", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("bytes", "n")])
    own = Window.partitionBy("range").orderBy("key", "key_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = (rows.withColumn("own_bytes", F.coalesce(F.sum("size").over(own), F.lit(0)))
              .withColumn("own_n", F.count("size").over(own)).join(F.broadcast(starts), "range"))
    middle = (F.col("bytes_before") + F.col("own_bytes")) * 2 + F.col("size")
    placed = save(placed.select(
        "doc_id", "size", "text_crc32", "range", (F.col("n_before") + F.col("own_n")).alias("place"),
        F.least(F.lit(shards - 1), F.floor(middle * shards / F.lit(2 * max(total, 1)))).cast("int").alias("shard")), "shard-places")
    first = placed.groupBy("shard").agg(F.min("place").alias("first"))  # one row for each shard
    return (placed.join(F.broadcast(first), "shard")
            .select("doc_id", "size", "text_crc32", "shard", (F.col("place") - F.col("first")).alias("slot"), "range"))
