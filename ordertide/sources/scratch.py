"""Cutting lineage through the cluster's shared checkpoint folder."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir, else the context's checkpoint folder.

    If neither is set a temporary folder is made, which only local mode allows.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="ordertide-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The result survives lost executors and is never computed twice, and the
    optimizer knows its true size from the files: only below
    spark.sql.autoBroadcastJoinThreshold does it become a broadcast side.
    """
    path = f"{shared_folder(df.sparkSession)}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
