"""Session settings and the shared scratch folder."""

from __future__ import annotations

import gc
import io
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_local_scratch: str | None = None
_shipped: set[str] = set()  # applications whose workers have the package
_ONE_MACHINE = re.compile(r"local(\[[^-]*\])?")


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and benches on one machine; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("orevein")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """Folder for hand-off tables: the one the cluster names in ``spark.checkpoint.dir``.

    A machine-local folder is only used when Spark itself runs on this one machine.
    """
    global _local_scratch
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not _ONE_MACHINE.fullmatch(spark.conf.get("spark.master", "")):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="orevein-")
    return _local_scratch


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def package_archive() -> bytes:
    """This package's modules as a zip file that Python can import from."""
    home, held = Path(__file__).resolve().parent, io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as archive:
        for module in sorted(home.rglob("*.py")):
            archive.write(module, module.relative_to(home.parent))
    return held.getvalue()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers of a cluster import this package; once per application, nothing to do on one machine.

    The archive goes to the shared scratch folder, from which Spark gives it to every executor, later ones too.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped or _ONE_MACHINE.fullmatch(spark.conf.get("spark.master", "")):
        return
    path = f"{scratch_path(spark, 'package')}/{Path(__file__).resolve().parent.name}.zip"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(package_archive()))
    out.close()
    spark.sparkContext.addPyFile(path)
    _shipped.add(application)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder in any store Spark can write to."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs now.

    Spark removes them once the driver has collected the plans that made them as garbage; between two
    large steps it is worth asking for it, so that their files are not on disk together.
    """
    gc.collect()
    spark._jvm.System.gc()


class Scratch:
    """Hand-off tables of one run, all in one folder below the shared scratch folder."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark, self.folder = spark, scratch_path(spark, label)
        self._tables: list[tuple[DataFrame, str]] = []

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back; cuts the lineage and survives lost executors."""
        path = f"{self.folder}/{name}-{len(self._tables)}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._tables.append((out, path))
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that nothing reads any more."""
        for known, path in self._tables:
            if any(known is table for table in tables):
                delete_path(self.spark, path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    Cuts the lineage, survives lost executors, and gives the planner the true size
    of the table, so Spark broadcasts it only below its own checked threshold.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
