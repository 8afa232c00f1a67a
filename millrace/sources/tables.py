"""Readers and writers of the engine's Parquet tables."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Spark's own file server carries the archive, so executors need neither the package nor its folder.
    Where the package came in an archive itself (``--py-files``), the workers have it already.
    """
    sc = spark.sparkContext
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if sc.applicationId in _SHIPPED or not os.path.isdir(home):
        return
    _SHIPPED.add(sc.applicationId)
    folder = tempfile.mkdtemp(prefix="millrace-code-")  # on the driver only
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    name = os.path.basename(home)
    path = os.path.join(folder, f"{name}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for at, _, files in os.walk(home):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(at, f)
                    z.write(full, os.path.join(name, os.path.relpath(full, home)))
    sc.addPyFile(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a dataset folder; a folder or a single file, both named ``<name>.parquet``."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """A folder of this application in the one all executors share, ``spark.checkpoint.dir``.

    Where that is unset, a local master (tests, single machines) gets an own temporary folder; a
    cluster is refused, since its executors would write where the driver can't read. What is written
    here is deleted when the driver ends, or by ``clean``.
    """
    sc = spark.sparkContext
    if sc.applicationId not in _OWN:
        d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not d and not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = f"{d.rstrip('/')}/millrace-{sc.applicationId}" if d else tempfile.mkdtemp(prefix="millrace-")
        _OWN[sc.applicationId] = path
        atexit.register(_delete, sc, path)
    return _OWN[sc.applicationId]


def _delete(sc, path: str) -> None:
    try:
        file_system(sc, path).delete(sc._jvm.org.apache.hadoop.fs.Path(path), True)
    except Exception:  # noqa: BLE001 - the application may be gone already
        shutil.rmtree(path.removeprefix("file://"), ignore_errors=True)


def file_system(sc, path: str):
    """Hadoop's file system of a path, local or remote."""
    return sc._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(sc._jsc.hadoopConfiguration())


def clean(spark: SparkSession) -> None:
    """Delete all stored intermediate tables of this application; what was read from them is gone."""
    path = _OWN.pop(spark.sparkContext.applicationId, None)
    if path:
        _delete(spark.sparkContext, path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet into the shared folder and read it back.

    Cuts the lineage: what follows survives the loss of any executor without running the costly
    steps again, and readers profit from column pruning and row group statistics.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """A scan with fewer partitions than cores (small or unsplittable files) dealt out to all cores.

    For rows about to enter a costly per-row kernel. Larger scans stay as they are; only plans
    without a shuffle should come here, as the partitions are counted by planning.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
