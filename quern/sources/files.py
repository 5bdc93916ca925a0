"""Files in and out."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quern.functions.text import unix_lines


def there(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, on any file system that Spark knows."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_documents(spark: SparkSession, folder: str, pattern: str = "*.md") -> DataFrame:
    """(source_file, text): the matching files of a folder, each as one text with line feeds; none gives no rows."""
    raw = spark.read.option("pathGlobFilter", pattern).text(folder, wholetext=True)
    return raw.select(F.col("_metadata.file_name").alias("source_file"), unix_lines(F.col("value")).alias("text"))


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Records of a JSON-lines file or folder; a missing one gives no rows, blank lines are skipped, a bad line fails."""
    if not there(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> None:
    """Writes a folder of JSON-lines files, over what was there unless appending."""
    df.write.mode("append" if append else "overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A whole JSON document: one row for an object, one for each element of an array."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def write_report(report: dict, path: str) -> None:
    """Writes a small report as indented JSON on the driver."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(report, ensure_ascii=False, indent=2), encoding="utf-8")


def save_report(spark: SparkSession, report: dict, path: str) -> None:
    """The same on any file system that Spark knows."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(json.dumps(report, ensure_ascii=False, indent=2).encode()))
    out.close()


def save_embeddings(df: DataFrame, path: str, order: str = "item_seq", vec: str = "vec") -> None:
    """Writes vectors keyed by their record."""
    df.select(F.col(order).alias("item_seq"), F.col(vec).cast("array<float>").alias("vec")).write.mode("overwrite").parquet(path)


def load_embeddings(spark: SparkSession, path: str) -> DataFrame | None:
    """(item_seq, vec), or None where there is no such file."""
    return spark.read.parquet(path) if there(spark, path) else None


def load_yaml(path: str) -> dict:
    """A YAML file as a dict; an empty file is an empty dict."""
    try:
        import yaml
    except ImportError as e:
        raise ImportError("PyYAML is needed to read settings from YAML files") from e
    return yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}


def load_prompt(path: str) -> str:
    """A prompt template without white space at its ends."""
    return Path(path).read_text(encoding="utf-8").strip()
