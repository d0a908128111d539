"""Sessions, the folder that all executors share, and work tables in it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """What ``spark.checkpoint.dir`` names. Where that is unset, a temporary folder in local mode; on a cluster it has to be set, as only the deployment knows a
    folder that all machines see."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        master = spark.sparkContext.master
        if held.isDefined():
            found = held.get()
        elif master.startswith("local") and not master.startswith("local-cluster"):
            found = tempfile.mkdtemp(prefix="ligaspark-")
        else:
            raise ValueError("spark.checkpoint.dir is not set; it has to name a folder that the driver and all executors share")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def work_path(spark: SparkSession, kind: str = "work") -> str:
    return f"{shared_folder(spark)}/ligaspark-{kind}-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` by way of a Parquet table in the shared folder: its plan ends there, it is computed once, and a lost executor costs a reread."""
    path = work_path(df.sparkSession)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._ligaspark_path = path
    return back


def remove(spark: SparkSession, path: str) -> None:
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def discard(*frames: DataFrame) -> None:
    """Delete tables that :func:`written` made and no plan reads any more."""
    for df in frames:
        if path := getattr(df, "_ligaspark_path", None):
            remove(df.sparkSession, path)


def session(app: str = "ligaspark", **conf: str) -> SparkSession:
    """A session with adaptive execution on and UTC times; everything else comes from the deployment or ``conf``."""
    base = {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.session.timeZone": "UTC"}
    builder = SparkSession.builder.appName(app)
    for k, v in (base | conf).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
