"""Shared small helpers: reading tables, saving steps to the shared folder, word expressions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import ensure_checkpoint_dir

#: the class of white space, as characters and as a regular expression
BLANKS = " \t\n\x0b\x0c\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(columns: list[str], name: str) -> str:
    """``name`` with as many underscores after it as it takes to differ from all ``columns``."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def fresh_prefix(columns: list[str]) -> str:
    """Underscores that no column starts with."""
    prefix = "_"
    while any(c.startswith(prefix) for c in columns):
        prefix += "_"
    return prefix


def save(df: DataFrame, tag: str, by: str | None = None) -> DataFrame:
    """Writes ``df`` as Parquet below the shared checkpoint folder and reads it back.

    Later steps prune columns and rows of it, and a lost executor costs no more than the files' readers.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(doc_id: Column, parts: int) -> Column:
    """Remainder of crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % parts


def trimmed(text: Column) -> Column:
    return F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; null and blank texts give an empty one."""
    inner = trimmed(text)
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE_RUN))


def count_of(text: Column, chars: str) -> Column:
    """How many characters of the regular expression class ``chars`` a text has."""
    return F.regexp_count(text, F.lit(f"[{chars}]"))


def _paired(left: str, right: str, ahead: int) -> Column:
    return F.transform(left, lambda x, i: F.xxhash64(x, F.get(right, i + ahead)))


def with_window_hashes(df: DataFrame, words: str, width: int, out: str) -> DataFrame:
    """Adds ``out``: hashes of all windows of ``width`` words, first to last; shorter texts give an empty array.

    Hashes of twice the width come from two neighbouring ones, so a window costs a few steps whatever its width.
    Every step is a column of its own: inside one expression an array would be built again for each element.
    """
    df = df.withColumn("_h1", F.transform(words, lambda x: F.xxhash64(x)))
    names, size, parts = ["_h1"], 1, [(1, "_h1")] if width & 1 else []
    while size * 2 <= width:
        last, size = names[-1], size * 2
        df = df.withColumn(f"_h{size}", _paired(last, last, size // 2))
        names.append(f"_h{size}")
        if width & size:
            parts.append((size, f"_h{size}"))
    joined, at = parts[0][1], parts[0][0]
    for size, name in parts[1:]:
        df = df.withColumn(f"_j{at}", _paired(joined, name, at))
        joined, at = f"_j{at}", at + size
        names.append(joined)
    n = F.size(words) - (width - 1)
    df = df.withColumn(out, F.when(n > 0, F.slice(joined, 1, F.greatest(n, F.lit(1)))).otherwise(F.array().cast("array<bigint>")))
    return df.drop(*names)
