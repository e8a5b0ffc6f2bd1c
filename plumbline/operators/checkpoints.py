"""Where iterations keep their state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder that the session names; one below its warehouse only where none is set, as in tests."""
    return spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints"


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage of an iteration's state with a checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(checkpoint_root(df.sparkSession))
    return df.checkpoint(eager=True)
