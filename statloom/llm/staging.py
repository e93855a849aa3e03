"""Intermediate tables in the shared folder that the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from statloom.operators.staging import Workspace, session_workspace
from statloom.operators.staging import shared_folder as shared_folder


def stage(df: DataFrame) -> DataFrame:
    """Write a table once and read it back: its lineage ends here and its true size is known to the
    planner. The files go with the session, or with ``session_workspace(spark).clear()``."""
    return session_workspace(df.sparkSession).keep(df, "stage")


def workspace(spark: SparkSession) -> Workspace:
    """A workspace for tables that are of no use once a step is done."""
    return Workspace(spark, shared_folder(spark))
