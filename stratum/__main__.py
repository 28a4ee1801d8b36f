"""Command line: python -m stratum run|rebuild|contract|migrate ROOT [--steps ...] [--analyzer module:factory]."""

from __future__ import annotations

import argparse
import datetime as dt
import importlib
import json
import sys

from .config import EnrichConfig, Lake
from .plans.migrate import migrate
from .plans.pipeline import STEPS, Pipeline
from .session import session, ship


def main(args: list[str]) -> int:
    parser = argparse.ArgumentParser(prog="stratum", description=__doc__)
    parser.add_argument("command", choices=("run", "rebuild", "contract", "migrate"))
    parser.add_argument("root", help="folder of the lake, or 'env' for the folders that environment variables name")
    parser.add_argument("--steps", nargs="*", default=list(STEPS), choices=STEPS)
    parser.add_argument("--analyzer", help="module:factory of the analyzer; without it the gold step is left out")
    parser.add_argument("--batch-limit", type=int, default=10)
    given = parser.parse_args(args)
    make_analyzer = None
    if given.analyzer:
        module, _, name = given.analyzer.partition(":")
        make_analyzer = getattr(importlib.import_module(module), name)
    spark = session()
    ship(spark)
    lake = Lake.from_env() if given.root == "env" else Lake.at(given.root)
    pipeline = Pipeline(spark, lake, make_analyzer, EnrichConfig(batch_limit=given.batch_limit))
    if given.command == "migrate":
        migrate(pipeline.state, dt.datetime.now(dt.UTC).replace(tzinfo=None))
        return 0
    if given.command == "rebuild":
        print(json.dumps(pipeline.rebuild()))
        return 0
    results = [pipeline.contract()] if given.command == "contract" else pipeline.run(steps=tuple(given.steps))
    for r in results:
        print(json.dumps({"check": r.name, "passed": r.passed, "severity": r.severity, **r.metadata}, default=str))
    return 0  # checks warn and never block


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
