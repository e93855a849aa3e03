"""Relations that several branches of a plan read: written once, read back, removed at the end."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from statloom.sources import files

SETTING = "spark.checkpoint.dir"


class Workspace:
    """The intermediate relations of one run, as Parquet in a folder of their own.

    A kept relation ends the lineage: every branch scans its files, with the columns it needs, and the
    planner knows their size. So plans stay as large as one step, however deep the steps are nested, and a
    lost executor costs nothing that was written. As a context manager it removes its folder at the end;
    results must be written or collected by then. What a killed run leaves is removed when its session ends.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = f"{folder.rstrip('/')}/run-{uuid.uuid4().hex}"
        self._made = False

    def keep(self, df: DataFrame, name: str = "relation") -> DataFrame:
        """Write a relation and read it back."""
        if not self._made:
            files.make_until_exit(self.spark, self.folder)
            self._made = True
        path = f"{self.folder}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        """Remove everything that was kept so far."""
        if self._made:
            files.remove(self.spark, self.folder)
            self._made = False

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        self.clear()


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``. Where nobody has set it, it is set
    to a folder in the warehouse, which all executors share as well."""
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or spark.conf.get(SETTING, None) or sc.getConf().get(SETTING)
    if folder is None:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


_SESSIONS: dict[str, Workspace] = {}


def session_workspace(spark: SparkSession) -> Workspace:
    """Workspace of all results of a session that are still to be computed; it ends with the session."""
    key = spark.sparkContext.applicationId
    if key not in _SESSIONS:
        _SESSIONS[key] = Workspace(spark, shared_folder(spark))
    return _SESSIONS[key]


def shared(df: DataFrame, name: str = "relation") -> DataFrame:
    """An intermediate that several branches read, kept in the workspace of its session."""
    return session_workspace(df.sparkSession).keep(df, name)
