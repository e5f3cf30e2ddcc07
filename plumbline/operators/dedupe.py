"""Keep-first de-duplication and accept/reject splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.session import saved

REASON = "_reject_reason"

# A list of repeated keys up to this size, as measured, is broadcast.
BROADCAST_BYTES = 32 << 20


def reject_duplicates(
    df: DataFrame, key: str, order: list[str], bad: tuple[Column, str] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Adds ``_reject_reason``: NULL for the first row of each key in ``order``, else why not.

    ``key`` is trimmed text with blanks as NULL; ``order`` is unique per row (file and
    position). ``bad`` is a condition with its reason; such rows are out of the race for their key.

    Only keys that repeat matter, so they are found first, by a key-only partial aggregate
    that thins a hot key in the map tasks. The first position of every key is written out, so
    that the rows are built once for it. If the list of keys that repeat is measured to be
    small it is broadcast and the rows are not shuffled at all. Otherwise rows meet the first
    position of their key on key *and* position, which spreads a hot key over all tasks.
    Neither way puts the rows of one key into one task, as a window over the key would.
    """
    rules = [(F.col(key).isNull(), f"missing primary key {key}")]
    place = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    running = place
    if bad is not None:
        rules.insert(0, bad)
        # inside the aggregate, not a filter: as a filter the condition would be copied below
        # the joins that built the rows and evaluated again there
        running = F.when(~bad[0], place)
    per_key = df.groupBy(F.col(key).alias("__k")).agg(
        F.min(running).alias("__first"), F.count(running).alias("__n"))
    per_key = saved(per_key.where("__k is not null and __n > 0"), "first-of-key")
    repeated = per_key.where("__n > 1").drop("__n")
    width = 64 + 32 * len(order)
    size = repeated.agg(
        F.coalesce(F.sum(F.octet_length(F.col("__k").cast("string")) + width), F.lit(0)).alias("bytes")
    ).first().bytes

    if size <= broadcast_bytes:
        late = F.col("__k").isNotNull() & ~place.eqNullSafe(F.col("__first"))
        joined = df.join(F.broadcast(repeated), F.col(key) == F.col("__k"), "left")
        spent = ["__k", "__first"]
    else:
        parts = [F.col("__first") if len(order) == 1 else F.col(f"__first.{c}") for c in order]
        firsts = per_key.select("__k", *[part.alias(f"__f{i}") for i, part in enumerate(parts)])
        condition = F.col(key) == F.col("__k")
        for i, column in enumerate(order):
            condition = condition & F.col(column).eqNullSafe(F.col(f"__f{i}"))
        late = F.col("__k").isNull()
        joined = df.join(firsts, condition, "left")
        spent = ["__k", *[f"__f{i}" for i in range(len(order))]]
    rules.append((late, f"duplicate primary key {key}"))
    return joined.withColumn(REASON, first_reason(rules)).drop(*spent)


def accepted(df: DataFrame) -> DataFrame:
    return df.where(F.col(REASON).isNull()).drop(REASON)


def rejected(df: DataFrame) -> DataFrame:
    return df.where(F.col(REASON).isNotNull())


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return accepted(df), rejected(df)


def first_reason(rules: list[tuple[Column, str]]) -> Column:
    """Reason of the first rule that fires, NULL when none does."""
    return F.coalesce(*[F.when(condition, F.lit(reason)) for condition, reason in rules])
