"""Tables of blocks have rows of megabytes: what a task holds of them must not grow with the blocks of a file or a partition."""

import random
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stratum.llm import lm_scoring as lm
from stratum.llm import support
from stratum.llm.collocations import mine_phrases

from .common import documents, prose

_RECORDS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@pytest.fixture
def kept(spark, monkeypatch):
    """By name of a kept table: the plan that made it, and the rows of its row groups.  A block has five documents."""
    found, real = {}, support.Scratch.keep

    def keep(self, df, name, *args, **named):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        table = real(self, df, name, *args, **named)
        files = [pq.ParquetFile(f).metadata for f in Path(table._scratch_path.removeprefix("file:").replace("//", "/")).rglob("*.parquet")]
        found[name] = (plan, [f.row_group(i).num_rows for f in files for i in range(f.num_row_groups)])
        return table

    monkeypatch.setattr(support.Scratch, "keep", keep)
    monkeypatch.setattr(support, "WIDE_GROUP_BYTES", 4_000, raising=False)
    spark.conf.set(_RECORDS, "5")
    yield found
    spark.conf.unset(_RECORDS)


def one_file(spark, n=40):
    rng = random.Random(4)
    return documents(spark, [(i, prose(rng, 1_000)) for i in range(n)]).coalesce(1)


def test_lm_scoring_holds_few_blocks_at_once(spark, kept):
    assert lm.score_texts(one_file(spark), F.col("doc_id") % 5 != 1).count() == 40
    assert kept["blocks"][1] == [1] * 8
    assert all(n == 1 for name in ("counted", "asked", "levels") for n in kept[name][1])
    assert "collect_list" not in kept["counted"][0]


def test_collocations_hold_few_blocks_at_once(spark, kept):
    assert mine_phrases(one_file(spark), min_count=5).top.count() > 0
    assert kept["blocks"][1] == [1] * 8
    assert "collect_list" not in kept["keys"][0]
