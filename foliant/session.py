"""Session helpers: table access, checkpoints that survive lost executors, code for the workers."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once a context, so that their Python workers can import it."""
    sc = spark.sparkContext
    if getattr(sc, "_foliant_shipped", False):
        return
    root = Path(__file__).resolve().parent
    if root.is_dir():  # not from an archive, which was shipped already
        archive = Path(tempfile.mkdtemp(prefix="foliant-")) / f"{root.name}.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        sc.addPyFile(str(archive))
    sc._foliant_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster, set here only where the session names none (tests, local runs)."""
    sc = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not shared:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = os.path.join(tempfile.gettempdir(), "foliant-checkpoints")
    return shared


def scratch(spark: SparkSession) -> str:
    """A new path in the shared folder, deleted when the Python process ends; drop_written() does so earlier."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/foliant-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(_drop_at_exit)
    _written.append((spark, path))
    return path


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a table written to the shared folder: compressed columns, readable after any executor is lost."""
    spark = df.sparkSession
    path = scratch(spark)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_written: list[tuple[SparkSession, str]] = []


@contextmanager
def written() -> Iterator[None]:
    """What cut() and scratch() write within is deleted at the end: use results within, so that long sessions don't fill their disk."""
    before = len(_written)
    try:
        yield
    finally:
        drop_written(before)


def drop_written(keep: int = 0) -> None:
    """Delete the tables that cut() wrote in this process, but the first `keep`."""
    while len(_written) > keep:
        spark, path = _written.pop()
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _drop_at_exit() -> None:
    try:
        drop_written()
    except Exception:  # the context was stopped before
        for _, path in _written:
            if path.startswith(("/", "file:")):
                shutil.rmtree(path.removeprefix("file://"), ignore_errors=True)


def local_session(cpus: int | str = 8, partitions: int = 8) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
