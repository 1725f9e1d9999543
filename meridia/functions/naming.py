"""Names, display text and parameter maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_feature_name(name: Column) -> Column:
    """Drop the block prefix of a prepared feature (``numeric__``, ``categorical__``)."""
    return F.regexp_replace(name, "^(numeric|categorical)__", "")


def clean_feature_text(name: str) -> str:
    """The same for a name at the driver."""
    return name.removeprefix("numeric__").removeprefix("categorical__")


def slug(name: Column) -> Column:
    """Lower case, spaces to underscores, brackets removed."""
    return F.translate(F.lower(name), " ()", "_")


def signed(value: Column, places: int = 4) -> Column:
    """Decimal text that always shows its sign, without zeros at the end but for one place."""
    text = F.regexp_replace(F.format_string(f"%.{places}f", F.abs(value)), r"(\.\d+?)0+$", "$1")
    return F.concat(F.when(value >= 0, F.lit("+")).otherwise(F.lit("-")), text)


def params_to_json(params: Column) -> Column:
    """Parameter map to JSON with keys in name order."""
    ordered = F.map_from_entries(F.array_sort(F.map_entries(params)))
    return F.to_json(ordered)


def params_from_json(text: Column) -> Column:
    return F.from_json(text, "map<string,string>")


def without_param(params: Column, key: str) -> Column:
    """The map less one key: what stays fixed while that key is swept."""
    return F.map_filter(params, lambda k, _: k != F.lit(key))
