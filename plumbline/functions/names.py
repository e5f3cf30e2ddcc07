"""Column-name normalisation and alias resolution (schema work only, no rows)."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.casts import blank_to_null


def normalize_name(name: str) -> str:
    """Lower-case ``[0-9a-z_]`` form: every other run of characters is one underscore."""
    return "_".join(re.findall(r"[0-9a-z]+", name.lower()))


def normalized(name: Column) -> Column:
    """``normalize_name`` for a column of names."""
    return F.btrim(F.regexp_replace(F.lower(name), "[^0-9a-z]+", "_"), F.lit("_"))


def sources_by_target(columns: Iterable[str], aliases: Mapping[str, str]) -> dict[str, list[str]]:
    """Target name -> the given columns that feed it, the column of that very name first."""
    feeds: dict[str, list[str]] = {}
    for column in columns:
        key = column if column.startswith("_") else normalize_name(column)
        feeds.setdefault(aliases.get(key, key), []).append(column)
    return {
        target: sorted(parts, key=lambda c: normalize_name(c) != normalize_name(target))
        for target, parts in feeds.items()
    }


def canonicalize(df: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """Normalise names, fold aliases into their canonical column, trim text, blank -> NULL.

    Names starting with an underscore are ingest metadata and stay untouched. When several
    columns feed one name, the first non-blank value wins, the canonical column before aliases.
    """
    types = dict(df.dtypes)

    def value(column: str) -> Column:
        quoted = F.col(f"`{column}`")
        return blank_to_null(quoted) if types[column] == "string" else quoted

    selected = []
    for target, parts in sources_by_target(df.columns, aliases).items():
        if target.startswith("_"):
            selected.append(F.col(target))
        elif len(parts) == 1:
            selected.append(value(parts[0]).alias(target))
        else:
            selected.append(F.coalesce(*[value(part) for part in parts]).alias(target))
    return df.select(*selected)


def rename_only(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Normalised, contract-renamed columns with their values left as they are."""
    selected = []
    for target, parts in sources_by_target(df.columns, renames).items():
        columns = [F.col(f"`{part}`") for part in parts]
        selected.append((columns[0] if len(columns) == 1 else F.coalesce(*columns)).alias(target))
    return df.select(*selected)


def data_columns(df: DataFrame) -> list[str]:
    return [column for column in df.columns if not column.startswith("_")]


def column_or(df: DataFrame, name: str, otherwise: Column) -> Column:
    return F.col(name) if name in df.columns else otherwise
