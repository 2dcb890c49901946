"""Session, table and lineage helpers shared by every operator."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def session(app: str = "newsloom", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A local session with the settings the tests and the bench use; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers once per application, so they need no installation of it."""
    sc = spark.sparkContext
    if _shipped.get(sc.applicationId):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="newsloom-code-")
    atexit.register(shutil.rmtree, folder, True)
    path = os.path.join(folder, "newsloom.zip")
    with zipfile.ZipFile(path, "w") as z:
        for at, _, files in os.walk(root):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(at, f)
                    z.write(full, os.path.join("newsloom", os.path.relpath(full, root)))
    sc.addPyFile(path)
    _shipped[sc.applicationId] = True


_shipped: dict[str, bool] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir; a local one only where that is unset and Spark runs on one machine (tests)."""
    ship(spark)
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return sc._jsc.sc().getCheckpointDir().get()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if not named:
        named = tempfile.mkdtemp(prefix="newsloom-ckpt-")
        atexit.register(shutil.rmtree, named, True)
    sc.setCheckpointDir(named)
    return named


def pin(df: DataFrame) -> DataFrame:
    """Cut the lineage: the rows are written to the shared checkpoint folder, so a lost executor costs nothing."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def pin_table(df: DataFrame) -> DataFrame:
    """Like `pin`, as a compressed columnar table in the same shared folder, for rows that carry texts.

    The table is removed when the driver ends.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/newsloom-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Removes a table of `pin_table` before the driver ends: one that a later round of a loop replaced."""
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        _remove(df.sparkSession, folder)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)
    except Exception:  # the session ended before; the cluster's own cleaning of the folder remains
        shutil.rmtree(path.removeprefix("file:").replace("//", "/"), ignore_errors=True)


def fingerprint(col, seed: int = 42):
    """64 bits of a value; two of them under different seeds serve as an identity."""
    return F.xxhash64(F.lit(seed), col)


def null_safe(col, default=""):
    return F.coalesce(col, F.lit(default))


def data_dir(default: str = "/root/testdata/sf0.001") -> str:
    return os.environ.get("NEWSLOOM_DATA", default)
