"""Tables written in the middle of a job, in the cluster's shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def staging_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else one in the shared warehouse."""
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_staged"


def new_folder(spark: SparkSession, name: str) -> str:
    """A path not used before, below one folder per application."""
    application = spark.sparkContext.applicationId
    return f"{staging_folder(spark)}/{application}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` once and read it back, so that all later uses see the same rows.

    Cuts the lineage: a lost executor costs a read, not a recomputation.
    """
    spark = df.sparkSession
    path = new_folder(spark, "stage")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
