"""Type detection on text values.

Each value maps to one bit. ``bit_or`` over a column then gives the set of kinds seen in
one partially aggregated integer, and the merge rules work on that set.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.functions.casts import DECIMAL_TEXT, INTEGER_TEXT, SPECIAL_NUMBER_TEXT

BOOLEAN, INTEGER, DECIMAL, TIMESTAMP, DATE, TEXT = 1, 2, 4, 8, 16, 32

# Accepted text forms.
DATE_TEXT = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
TIMESTAMP_TEXT = (
    r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
    r"(T[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}Z| [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2})$"
)

# Expected type -> observed types that satisfy it.
COMPATIBLE = {
    "string": {"string", "integer", "decimal", "boolean", "date", "timestamp"},
    "decimal": {"decimal", "integer"},
    "integer": {"integer"},
    "timestamp": {"timestamp", "date"},
    "date": {"date"},
    "boolean": {"boolean"},
}


def kind_bit(column: str) -> Column:
    """The kind of one value as a bit, 0 for a null or empty value."""
    text = f"btrim(cast(`{column}` as string), ' \\t\\n\\r')"
    return F.expr(f"""
        case when `{column}` is null or cast(`{column}` as string) = '' then 0
             when lower({text}) in ('true', 'false') then {BOOLEAN}
             when {text} rlike r'{INTEGER_TEXT}' then {INTEGER}
             when {text} rlike r'{DECIMAL_TEXT}' or {text} rlike r'{SPECIAL_NUMBER_TEXT}' then {DECIMAL}
             when {text} rlike r'{TIMESTAMP_TEXT}' and try_cast({text} as timestamp_ntz) is not null
                  then {TIMESTAMP}
             when {text} rlike r'{DATE_TEXT}' and try_cast({text} as date) is not null then {DATE}
             else {TEXT} end""")


def merged_type(bits: str, date_as_timestamp: bool = False) -> Column:
    """Name of the column type for a set of kinds, given the column that holds the set.

    Dates and timestamps mixed give a timestamp. With ``date_as_timestamp`` a column of
    dates alone does too, which makes date contracts fail.
    """
    dates = "timestamp" if date_as_timestamp else "date"
    return F.expr(f"""
        case when coalesce(`{bits}`, 0) = 0 then 'string'
             when `{bits}` = {INTEGER} then 'integer'
             when `{bits}` & ~{INTEGER | DECIMAL} = 0 then 'decimal'
             when `{bits}` = {DATE} then '{dates}'
             when `{bits}` & ~{DATE | TIMESTAMP} = 0 then 'timestamp'
             when `{bits}` = {BOOLEAN} then 'boolean'
             else 'string' end""")
