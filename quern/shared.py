"""Tables kept in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; one of our own only in local mode, where it may be unset."""
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="quern-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def _own_folder(spark: SparkSession) -> str:
    """The part of the shared folder that belongs to this application."""
    return f"{shared_folder(spark)}/quern-{spark.sparkContext.applicationId}"


def clear(spark: SparkSession) -> None:
    """Removes the tables that this application has cut; results that still read them can't be read afterwards."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame, name: str = "table") -> DataFrame:
    """`df` written to the shared folder and read again: a short lineage that survives lost executors."""
    spark = df.sparkSession
    path = f"{_own_folder(spark)}/{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._quern_path = path
    return out


def forget(*tables: DataFrame) -> None:
    """Removes tables that were cut and that nothing reads any more, such as those of earlier rounds."""
    for df in tables:
        if path := getattr(df, "_quern_path", None):
            p = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path).getParent()
            p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once a session, so that their workers import it wherever they run."""
    context = spark.sparkContext
    if getattr(context, "_quern_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="quern-code-")) / "quern.zip"  # the driver's own file; Spark serves it
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._quern_shipped = True


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
