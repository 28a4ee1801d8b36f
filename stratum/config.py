"""Configuration: paths of the lake and options of the steps."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Lake:
    """Folders of the layers.  Any path that Spark can read will do."""

    bronze: str
    silver: str
    gold: str
    state: str

    @classmethod
    def at(cls, root: str) -> Lake:
        root = root.rstrip("/")
        return cls(f"{root}/lake/bronze", f"{root}/lake/silver", f"{root}/lake/gold", f"{root}/state")

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> Lake:
        """Folders from IG_DATA_DIR, or one by one from IG_BRONZE_DIR, IG_SILVER_DIR, IG_GOLD_DIR and IG_DB_PATH."""
        base = cls.at(env.get("IG_DATA_DIR", "data"))
        return cls(env.get("IG_BRONZE_DIR", base.bronze), env.get("IG_SILVER_DIR", base.silver), env.get("IG_GOLD_DIR", base.gold), env.get("IG_DB_PATH", base.state))


@dataclass(frozen=True)
class ScrapeConfig:
    urls: list[str]
    results_limit: int = 12
    results_type: str = "posts"


@dataclass(frozen=True)
class EnrichConfig:
    """Options of the gold step.

    A run takes at most `batch_limit` rows, oldest first.  With `compat` the
    mark then moves to the start of the run, past rows that were left out;
    else it moves to the last row of the batch.  `post_ids` restricts a run to
    some posts and leaves the mark alone.  `parallelism` bounds the external
    calls at one time.

    When the service's quota ends, a run pauses at most `quota_pauses` times,
    for as long as the service says (`quota_wait` seconds if it doesn't, and
    `quota_wait_max` at most); what hasn't been tried then stays pending.  A
    pause of `quota_task_wait` seconds at most, less than a round costs, is made
    by the task that is told so, of which several may pause at the same time.
    """

    batch_limit: int | None = 10
    post_ids: list[str] = field(default_factory=list)
    compat: bool = False
    attempts: int = 3
    parallelism: int = 4
    backoff_seconds: float = 2.0
    quota_pauses: int = 3
    quota_wait: float = 30.0
    quota_wait_max: float = 300.0
    quota_task_wait: float = 1.0
