"""Change files in, merged table out, each change once."""

from pyspark.sql import DataFrame, SparkSession, types as T

from ordertide.schema import feed_schema
from ordertide.sources.tables import Table


def follow_feed(
    spark: SparkSession, feed_folder: str, orders: T.StructType, target: Table, key: str,
    checkpoint: str, stamp, files_per_batch: int | None = None,
) -> None:
    """Merge all change files not yet seen into ``target``, then stop.

    The stream's checkpoint is the feed's offset: the next run sees only new
    files. Spark may hand a batch over twice after a failure; the table's log
    knows the last batch of this query and skips it. ``stamp`` gives the load
    time of a batch from its number and must give the same for a repeat.
    """
    reader = spark.readStream.schema(feed_schema(orders))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def merge(rows: DataFrame, batch: int) -> None:
        query = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        target.merge(rows, key, stamp(batch), feed=query, batch=batch)

    (
        reader.parquet(feed_folder)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
