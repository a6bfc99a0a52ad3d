"""Payload text parsing (P1-P3), as native ``Column`` expressions.

``{item:count,...}`` text becomes one row per entry; dict-literal avatar text
becomes a struct. No Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.constants import AVATAR_KEYS


def _strip_quotes(c: Column) -> Column:
    return F.regexp_replace(F.trim(c), r"^u?['\"]|['\"]$", "")


def payload_entries(item_list) -> Column:
    """Array of ``key:value`` entries of a ``{k:v,...}`` text (braces stripped)."""
    c = F.col(item_list) if isinstance(item_list, str) else item_list
    body = F.regexp_replace(F.trim(c), r"^\{|\}$", "")
    return F.split(body, ",")


def entry_parts(entry) -> tuple[Column, Column]:
    """(item key, count) of one ``key:value`` entry, as BIGINT; NULL when not an integer."""
    c = F.col(entry) if isinstance(entry, str) else entry
    key = _strip_quotes(F.split_part(c, F.lit(":"), F.lit(1)))
    val = _strip_quotes(F.split_part(c, F.lit(":"), F.lit(2)))
    return key.try_cast("bigint"), val.try_cast("bigint")


def explode_payload(df: DataFrame, item_list: str = "item_list", keep: list[str] | None = None,
                    item_col: str = "item_id", count_col: str = "cnt") -> DataFrame:
    """One row per ``item:count`` entry.

    Entries whose key is not an integer are dropped (this removes ``{}``);
    duplicate keys stay as separate rows, to be summed by the caller.
    """
    keep = [c for c in (keep if keep is not None else df.columns) if c != item_list]
    entry = F.explode(payload_entries(item_list)).alias("_entry")
    rows = df.select(*keep, entry)
    key, val = entry_parts("_entry")
    return rows.select(*keep, key.alias(item_col), val.alias(count_col)).where(F.col(item_col).isNotNull())


def dict_literal_to_json(text) -> Column:
    """Normalise Python dict-literal text (``u'..'``, ``2L``, ``None``) to JSON."""
    c = F.col(text) if isinstance(text, str) else text
    c = F.regexp_replace(c, r"\bu'", "'")
    c = F.regexp_replace(c, r"(\d+)[lL]\b", "$1")
    c = F.regexp_replace(c, r"\bNone\b", "null")
    c = F.regexp_replace(c, r"\bTrue\b", "true")
    c = F.regexp_replace(c, r"\bFalse\b", "false")
    return c


def attributes(text, keys=AVATAR_KEYS) -> Column:
    """Struct of the named attributes of a dict-literal text; ``[]`` gives nulls."""
    schema = "struct<" + ",".join(f"`{k}`:string" for k in keys) + ">"
    return F.from_json(dict_literal_to_json(text), schema,
                       {"allowUnquotedFieldNames": "true", "allowSingleQuotes": "true",
                        "mode": "PERMISSIVE"})


def extract_attributes(df: DataFrame, text: str = "wear", keys=AVATAR_KEYS,
                       keep: list[str] | None = None) -> DataFrame:
    keep = keep if keep is not None else [c for c in df.columns if c != text]
    parsed = attributes(text, keys).alias("_attrs")
    out = df.select(*keep, parsed)
    return out.select(*keep, *[F.col("_attrs").getField(k).alias(k.lower()) for k in keys])
