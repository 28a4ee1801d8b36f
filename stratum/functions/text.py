"""String expressions of the silver layer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_blank(text: Column) -> Column:
    """True for null and for text of Unicode white space only."""
    return F.coalesce(F.regexp_replace(text, r"(?U)\s", "") == "", F.lit(True))


def strip_zone_mark(text: Column) -> Column:
    """Text without a trailing `Z`."""
    return F.regexp_replace(text, "Z$", "")


def post_url(url: Column, shortcode: Column) -> Column:
    """The url, or the one that a shortcode implies; null if both are null."""
    return F.coalesce(url, F.concat(F.lit("https://instagram.com/p/"), shortcode, F.lit("/")))


def list_to_json(values: Column) -> Column:
    """JSON text of an array; a null array counts as empty."""
    return F.coalesce(F.to_json(values), F.lit("[]"))
