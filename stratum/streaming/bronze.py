"""Bronze files as a stream into the table of posts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.normalize import normalize
from ..plans.silver import merge_posts, record_progress
from ..schemas import BRONZE
from ..sources.bronze import dataset_of_file
from ..sources.files import delete
from ..sources.state import State

LEDGER = "stream_batches"


def merge_batch(state: State, batch: DataFrame, stream: str, batch_id: int, now: dt.datetime) -> None:
    """Merge bronze rows into the posts, once for each batch of a stream.

    A ledger has the batch before its data is merged, with the timestamp of
    the run.  Data, progress and the note that the batch is done are one
    transaction.  A batch that is done isn't merged again; one that wasn't
    finished is merged with the timestamp that it had.
    """
    ledger, spark = state.table(LEDGER), state.spark
    row = ledger.lookup((stream, batch_id)).first()
    if row is not None and row.done:
        return
    run_ts = row.run_ts if row is not None else now

    def note(n_rows: int | None, done: bool) -> None:
        ledger.upsert(spark.createDataFrame([(stream, batch_id, run_ts, n_rows, done)], ledger.schema))

    if row is None:
        note(None, False)
    staging = f"{state.root}/_staging/stream"
    batch.write.mode("overwrite").parquet(staging)
    rows = spark.read.schema(batch.schema).parquet(staging)
    with state.transaction():
        merge_posts(state, normalize(rows, F.col("source_dataset")), run_ts)
        record_progress(state, rows.select("source_dataset").distinct(), run_ts)
        note(rows.count(), True)
    delete(spark, staging)


def stream_bronze(state: State, bronze: str, checkpoint: str, schema: T.StructType = BRONZE, available_now: bool = True) -> StreamingQuery:
    """Start a query over the Parquet files of one schema in a folder.

    The checkpoint remembers the files that are done; each micro-batch is
    merged like a batch run, and once.  With `available_now` the query ends
    when it has seen what is there.
    """
    files = state.spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(bronze)
    rows = files.select("*", dataset_of_file().alias("source_dataset"))

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_batch(state, batch, checkpoint, batch_id, dt.datetime.now(dt.UTC).replace(tzinfo=None))

    writer = rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
