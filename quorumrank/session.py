"""Session defaults, table reads and job tags."""

from __future__ import annotations

import json
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def session(app: str = "quorumrank", **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC; further settings by keyword, dots written as double underscores."""
    builder = SparkSession.builder.appName(app).config(
        "spark.sql.adaptive.enabled", "true"
    ).config("spark.sql.session.timeZone", "UTC")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tag_query(spark: SparkSession, node: str, methodology_version: str, run_id: str = "") -> None:
    """Labels the jobs that follow with what runs them, as JSON."""
    said = {"app": "quorumrank", "node": node, "methodology_version": methodology_version, "run_id": run_id}
    spark.sparkContext.setJobDescription(json.dumps(said, sort_keys=True))


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.

    Where that is unset, local mode takes a temporary folder; on a cluster it must be set, as no machine's own folder will do.
    """
    found, master = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.master
    if not found:
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="quorumrank-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def frozen(df: DataFrame) -> DataFrame:
    """``df`` computed once into the reliable shared folder."""
    spark = df.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def ensure_table(spark: SparkSession, name: str, schema: StructType) -> DataFrame:
    """A catalog table, created empty where it doesn't exist."""
    if not spark.catalog.tableExists(name):
        spark.createDataFrame([], schema).write.saveAsTable(name)
    return spark.table(name)


def run_sql(spark: SparkSession, text: str, **args: object) -> DataFrame:
    """SQL with named parameters (``:name``), never spliced into the text."""
    return spark.sql(text, args=args)
