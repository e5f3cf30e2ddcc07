"""Join helpers that hold up when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Equi-join in which NULL equals NULL. The right copies of the keys are dropped."""
    renamed = right.withColumnsRenamed({column: f"__r_{column}" for column in on})
    condition = None
    for column in on:
        same = F.col(column).eqNullSafe(F.col(f"__r_{column}"))
        condition = same if condition is None else condition & same
    return left.join(renamed, condition, how).drop(*[f"__r_{column}" for column in on])


LOOKUP_ROWS = 200_000
SALTS = 32


def lookup(left: DataFrame, right: DataFrame, key: str, spread_by: list[str],
           most: int = LOOKUP_ROWS, salts: int = SALTS) -> DataFrame:
    """Left join of many rows to one row per ``key``, safe when one key owns most of the rows.

    ``right`` is counted up to ``most`` rows. If it stays below, it is broadcast. Otherwise
    the rows of a key are dealt over ``salts`` tasks by ``spread_by`` and ``right`` is repeated
    once per salt.
    """
    if right.limit(most + 1).count() <= most:
        return left.join(F.broadcast(right), key, "left")
    dealt = left.withColumn("__salt", F.pmod(F.hash(*spread_by), F.lit(salts)))
    copies = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(copies, [key, "__salt"], "left").drop("__salt")


def text_windows(text: Column, lengths: list[int]) -> Column:
    """All substrings of ``text`` that have one of ``lengths``, each once."""
    empty = F.array().cast("array<string>")

    def windows(size: int) -> Column:
        starts = F.sequence(F.lit(1), F.length(text) - F.lit(size - 1))
        cut = F.transform(starts, lambda start: F.substring(text, start, F.lit(size)))
        return F.when(F.length(text) >= size, cut).otherwise(empty)

    return F.array_distinct(F.concat(*[windows(size) for size in lengths])) if lengths else empty


def name_lengths(names: DataFrame, column: str) -> list[int]:
    """Distinct text lengths: one small list, however many names there are."""
    rows = names.select(F.length(column).alias("n")).where("n > 0").distinct().collect()
    return sorted(row.n for row in rows)


def best_mention(
    texts: DataFrame, text: str, score: str, names: DataFrame, name: str, on: list[str] | None = None,
    most: int = LOOKUP_ROWS,
) -> DataFrame:
    """Highest ``score`` of the texts that hold each name anywhere, per ``on`` and name.

    Substring search as an equi-join: a text is cut into its windows of the name lengths and
    each window is looked up by equality, so there is no nested loop. Up to ``most`` names, as
    counted, are broadcast. Beyond that the windows are first reduced to one row each, in the
    map tasks already, so a name that stands in a third of all texts does not pile up.
    """
    keys = on or []
    pieces = texts.select(
        *keys, score, F.explode(text_windows(F.col(text), name_lengths(names, name))).alias(name))
    if names.limit(most + 1).count() <= most:
        pieces = pieces.join(F.broadcast(names.select(*keys, name)), [*keys, name], "left_semi")
        return pieces.groupBy(*keys, name).agg(F.max(score).alias(score))
    best = pieces.groupBy(*keys, name).agg(F.max(score).alias(score))
    return best.join(names.select(*keys, name), [*keys, name], "left_semi")
