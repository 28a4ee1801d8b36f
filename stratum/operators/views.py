"""Serving views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import ANALYTICS_VIEW


def analytics_view(posts: DataFrame, analyses: DataFrame, profiles: DataFrame) -> DataFrame:
    """A row for each post with its analysis and its owner's current profile, where there are any."""
    gold = analyses.select("post_id", "result_json", F.col("analysed_at").alias("gold_analysed_at"))
    current = profiles.where("is_current").select("owner_id", "profile_key", "channel", "effective_from", "effective_to", "is_current")
    joined = posts.join(gold, "post_id", "left").join(current, "owner_id", "left")
    return joined.select(*(f.name for f in ANALYTICS_VIEW.fields))


def view_sql(prefix: str = "") -> str:
    """The same over catalog tables of these names, with a prefix."""
    own = {"result_json": "g", "gold_analysed_at": "g"} | dict.fromkeys(("profile_key", "channel", "effective_from", "effective_to", "is_current"), "d")
    columns = ", ".join(f"{own.get(f.name, 'p')}.{f.name}" for f in ANALYTICS_VIEW.fields)
    return (
        f"SELECT {columns} FROM {prefix}silver_ig_posts p LEFT JOIN (SELECT post_id, result_json, analysed_at AS gold_analysed_at FROM {prefix}gold_ig_analyses) g ON g.post_id = p.post_id "
        f"LEFT JOIN (SELECT * FROM {prefix}dim_profile WHERE is_current) d ON d.owner_id = p.owner_id"
    )
