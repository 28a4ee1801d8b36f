"""The pipeline as an ordered list of steps, and the full rebuild."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from ..config import EnrichConfig, Lake
from ..operators import checks
from ..operators.enrich import Analyzer
from ..schemas import TABLES
from ..sources.bronze import newest, read_or_none
from ..sources.catalog import bronze_rows, refresh
from ..sources.scrape import read_meta
from ..sources.state import BUCKET_ROWS, State
from .gold import run_gold
from .serving import VIEW, run_dim_profile, run_dim_time, run_view
from .silver import run_silver

#: Order of a scheduled run (bronze is ingested on demand), and its schedule for an external scheduler.
STEPS = ("silver", "gold", "dim_profile", "dim_time", "analytics_views")
SCHEDULE = "0 2 * * 1"


@dataclass
class Pipeline:
    """Runs the steps in order.  Without an analyzer the gold step is left out.

    Large tables start with `buckets` buckets and grow to about `bucket_rows` rows in each.
    """

    spark: SparkSession
    lake: Lake
    make_analyzer: Callable[[], Analyzer] | None = None
    enrich: EnrichConfig = field(default_factory=EnrichConfig)
    buckets: int = 16
    bucket_rows: int = BUCKET_ROWS

    @property
    def state(self) -> State:
        return State(self.spark, self.lake.state, self.buckets, self.bucket_rows)

    def run(self, run_ts: dt.datetime | None = None, steps: tuple[str, ...] = STEPS) -> list[checks.CheckResult]:
        """Run steps with one timestamp, and return the results of their checks."""
        run_ts = run_ts or dt.datetime.now(dt.UTC).replace(tzinfo=None)
        results: list[checks.CheckResult] = []
        for step in (s for s in STEPS if s in steps):
            if step == "silver":
                run_silver(self.lake, self.state, run_ts)
                results += self.bronze_checks() + self.silver_checks()
            elif step == "gold" and self.make_analyzer:
                run_gold(self.state, self.make_analyzer, run_ts, self.enrich)
                gold = self.state.table("gold_ig_analyses").read()
                results += [check(gold) for check in checks.GOLD_CHECKS]
            elif step == "dim_profile":
                dim = run_dim_profile(self.state, run_ts)
                results += [checks.no_overlap(dim), checks.ranges_valid(dim), checks.no_gaps(dim)]
            elif step == "dim_time":
                run_dim_time(self.state, last=run_ts.date() + dt.timedelta(days=365))
            elif step == "analytics_views":
                results.append(checks.has_rows("analytics_views_row_count_positive", run_view(self.state)))
        return results

    def bronze_checks(self) -> list[checks.CheckResult]:
        """Of the newest dataset."""
        last = newest(self.spark, self.lake.bronze)
        df = read_or_none(self.spark, last.path) if last else None
        results = [checks.has_rows("ig_posts_raw_has_rows", df), checks.has_meta(read_meta(self.spark, last.path) if last else None)]
        return results + ([checks.ids_not_null(df)] if df is not None else [])

    def silver_checks(self) -> list[checks.CheckResult]:
        """By what the commits noted of the posts, which aren't scanned where they noted it.

        Bronze rows are those of the files that lie there now, by the catalog, which opens the footers of new files only.
        """
        posts = self.state.table("silver_ig_posts")
        n = posts.n_rows()
        unique = checks.unique_by_commits(n) if posts.keys_checked() else checks.no_duplicates(posts.read())
        return [unique, checks.bounded_count(n, bronze_rows(refresh(self.state, self.lake.bronze)))]

    def contract(self) -> checks.CheckResult:
        """The state tables that exist against their schemas, and whether the analytics view can be queried."""
        return checks.schema_contract({n: self.state.table(n).read() for n in self.state.names() if n in TABLES}, {VIEW: lambda: run_view(self.state)})

    def rebuild(self, run_ts: dt.datetime | None = None) -> dict[str, int]:
        """Drop all state, replay every step, and count the rows of each table."""
        self.state.drop_all()
        self.run(run_ts)
        return {n: self.state.table(n).read().count() for n in self.state.names()}
