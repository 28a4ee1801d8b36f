"""Expressions over JSON documents that are stored as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_valid(text: Column) -> Column:
    """Whether text is a JSON document (false for null)."""
    return F.try_parse_json(text).isNotNull()


def json_field(text: Column, name: str) -> Column:
    """A field of the root object as text; empty where it is absent or null, null where the text is no JSON."""
    value = F.coalesce(F.try_variant_get(F.try_parse_json(text), f"$.{name}", "string"), F.lit(""))
    return F.when(json_valid(text), value)


def has_summarised_object(text: Column, name: str) -> Column:
    """Whether a field of the root object is an object with a summary that is not empty, zero, false or null."""
    root = F.try_parse_json(text)
    is_object = F.try_variant_get(root, f"$.{name}", "map<string,variant>").isNotNull()
    summary = F.try_variant_get(root, f"$.{name}.summary", "string")
    return F.coalesce(is_object & ~summary.isin("", "0", "0.0", "false", "[]", "{}"), F.lit(False))
