"""Incremental cleaning as a stream over the landing area."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from dayledger.operators.cleaning import clean, with_lineage
from dayledger.plans.committed import CommittedStore
from dayledger.schema import BATCH, DAY, RAW, SOURCE_FILE
from dayledger.sinks.days import AS_READ, write_days
from dayledger.sources.landing import stream_raw


def stream_ingest(
    spark: SparkSession,
    landing: str,
    history: str | CommittedStore,
    checkpoint: str,
    files_per_trigger: int = 3,
    run_id: str = "stream",
    drop_nan: bool = False,
    schema: StructType = RAW,
    quarantine: str | None = None,
) -> StreamingQuery:
    """Clean every file not yet seen, then stop. The checkpoint is the cursor.

    Unlike the batch cycle it goes by arrival, so a late file is read, and there is no
    scan cap. Each micro-batch overwrites its own (day, batch) partitions: a batch that
    is replayed after a failure writes its rows once, and a day whose files arrive in
    several batches keeps them all. The run id of a row ends in its batch. With a committed
    store as history every batch is a commit, and its days can be compacted.

    Every layout of the landing area is read. Rows of a file that names no day stop the query
    with the file's path; with a `quarantine` folder they go there instead, raw and by batch.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        run, undated = f"{run_id}_{batch_id}", F.col(DAY).isNull()
        if quarantine:
            write_quarantine(batch.where(undated), batch_id, quarantine)
            dated = batch.where(~undated)
        else:
            refused = F.raise_error(F.concat(F.lit("no day in the path of "), F.col(SOURCE_FILE))).cast("date")
            dated = batch.withColumn(DAY, F.coalesce(F.col(DAY), refused))
        rows = with_lineage(clean(dated.drop(SOURCE_FILE), drop_nan), run)
        if isinstance(history, CommittedStore):
            # The id of the query lies in its checkpoint, so it is the same after a restart.
            stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
            history.append(spark, rows, run, stream, batch_id)
        else:
            write_days(rows.withColumn(BATCH, F.lit(batch_id)), history, AS_READ, (DAY, BATCH))

    return (
        stream_raw(spark, landing, files_per_trigger, schema)
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_quarantine(rows: DataFrame, batch_id: int, path: str) -> None:
    """Replace what the batch has put there, as it may run twice."""
    writer = rows.drop(DAY).withColumn(BATCH, F.lit(batch_id)).write.partitionBy(BATCH).mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
