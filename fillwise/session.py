"""Session helpers: recommended settings and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings the engine relies on. AQE re-plans joins from measured sizes
# (a sort-merge join becomes a broadcast join only when the materialized side is
# under the threshold), coalesces small shuffle partitions and splits skewed ones.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


ARROW_BYTES, ARROW_BYTES_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "fillwise",
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", "8g")
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only a local-mode session without one gets a private scratch folder, as in tests.
    A cluster session without the setting is an error: a machine-local folder would
    not survive the loss of the executor that wrote it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running fillwise")
    local = tempfile.mkdtemp(prefix="fillwise-ckpt-")
    sc.setCheckpointDir(local)
    return local


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once a session (Spark's ``addPyFile``),
    so that they can import it wherever the driver was started."""
    sc = spark.sparkContext
    if getattr(sc, "_fillwise_shipped", False):
        return
    # Spark's own default lets a worker hold 64 MB of rows at once, and copies of them
    if spark.conf.get(ARROW_BYTES) == ARROW_BYTES_DEFAULT:
        spark.conf.set(ARROW_BYTES, "8m")
    top = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="fillwise-code-"), "fillwise_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    sc._fillwise_shipped = True


def _run_folder(spark: SparkSession) -> str:
    """This run's folder under the checkpoint folder; Hadoop deletes it when the driver ends."""
    sc = spark.sparkContext
    if not hasattr(sc, "_fillwise_run"):
        path = os.path.join(checkpoint_dir(spark), "fillwise", uuid.uuid4().hex)
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = at.getFileSystem(sc._jsc.hadoopConfiguration())
        files.mkdirs(at)
        files.deleteOnExit(at)
        sc._fillwise_run = path
    return sc._fillwise_run


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialize ``df`` as a parquet table in the shared checkpoint folder and
    return a DataFrame that reads it back.

    One computation of the input (an eager ``checkpoint()`` of an unpersisted
    plan computes it twice: once to count, once to write), and later readers get
    a columnar scan with column pruning. A lost executor re-reads the files
    instead of recomputing the lineage; nothing lives on a machine-local disk.
    """
    spark = df.sparkSession
    path = os.path.join(_run_folder(spark), uuid.uuid4().hex)
    df.write.mode("error").parquet(path)
    if not hasattr(spark.sparkContext, "_fillwise_tables"):
        spark.sparkContext._fillwise_tables = []
    spark.sparkContext._fillwise_tables.append(path)
    out = spark.read.parquet(path)
    out._fillwise_path = path
    return out


def tables_made(spark: SparkSession) -> list[str]:
    """Paths of the tables that ``cut_lineage`` wrote and ``discard`` has not deleted."""
    return list(getattr(spark.sparkContext, "_fillwise_tables", []))


def discard(spark: SparkSession, *tables: DataFrame | str) -> None:
    """Delete written tables that nothing reads any more (DataFrames of ``cut_lineage``, or paths)."""
    for t in tables:
        path = t if isinstance(t, str) else t._fillwise_path
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        if path in spark.sparkContext._fillwise_tables:
            spark.sparkContext._fillwise_tables.remove(path)
