"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN: dict[str, str] = {}  # by application, where no shared folder is set


def local_session(cores: int | str = "*", app: str = "terrawave") -> SparkSession:
    """A local session for tests and benches; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or in a local test a new temporary one."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _OWN:
            _OWN[app] = "file://" + tempfile.mkdtemp(prefix="spark-")
        at = _OWN[app]
    return at.rstrip("/")


def stash(df: DataFrame, name: str = "t") -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    back = spark.read.schema(schema).parquet(path)
    back._stash_path = path
    return back


BROADCAST = 64 << 20  # bytes


def _width(df: DataFrame) -> int:
    """Bytes of a row by its schema, as the optimizer counts them."""
    return df._jdf.schema().defaultSize() + 8


def small(df: DataFrame, most: int = BROADCAST) -> DataFrame:
    """df, marked for broadcast if its measured size is no more than so many bytes, else left to be shuffled.

    The size is that of the files of a written table, whose pages may be packed five times over, or else a count of rows times the width of one.
    """
    path = getattr(df, "_stash_path", None)
    if path:
        jvm = df.sparkSession._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        size = 5 * where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).getContentSummary(where).getLength()
    else:
        size = df.count() * _width(df)
    return F.broadcast(df) if size <= most else df


def release(*frames: DataFrame) -> None:
    """Delete stashed tables that no later plan reads."""
    for df in frames:
        path = getattr(df, "_stash_path", None)
        if path:
            jvm = df.sparkSession._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)
