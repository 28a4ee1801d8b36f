"""Serving step: dimensions and the analytics view."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dates import date_dimension
from ..operators.scd2 import changed_rows, observed_names
from ..operators.views import analytics_view, view_sql
from ..sources.reader import register
from ..sources.state import State

VIEW = "analytics_views"


def run_dim_profile(state: State, run_ts: dt.datetime) -> DataFrame:
    """Bring the profile dimension up to the names in the posts."""
    dim = state.guarded("dim_profile")
    observed = observed_names(state.table("silver_ig_posts").read())
    dim.upsert(changed_rows(dim.read(), observed, F.lit(run_ts)))
    return dim.read()


def run_dim_time(state: State, first: dt.date = dt.date(2020, 1, 1), last: dt.date | None = None) -> DataFrame:
    """Every day from first to last, by default a year from today."""
    last = last or dt.date.today() + dt.timedelta(days=365)
    state.table("dim_time").replace(date_dimension(state.spark, first, last))
    return state.table("dim_time").read()


def create_catalog_view(state: State, prefix: str = "") -> None:
    """Views of the state's tables in the session's catalog, and the analytics view over them.

    With a metastore they outlive the application; another one registers
    `stratum.sources.reader.StateSource` and sets `reader.PUSHDOWN` before it
    queries them.  Each query sees the versions that are current when it is planned.
    """
    register(state.spark, state.root, ("silver_ig_posts", "gold_ig_analyses", "dim_profile"), prefix)
    state.spark.sql(f"CREATE OR REPLACE VIEW {prefix}{VIEW} AS {view_sql(prefix)}")


def run_view(state: State) -> DataFrame:
    """Create or replace the view of posts, analyses and current profiles.

    It is there for the session, as `global_temp.analytics_views` for all
    sessions of the application, and for other applications by this function,
    which reads the state's current versions.
    """
    view = analytics_view(*(state.table(t).read() for t in ("silver_ig_posts", "gold_ig_analyses", "dim_profile")))
    view.createOrReplaceTempView(VIEW)
    view.createOrReplaceGlobalTempView(VIEW)
    return view
