"""Records as a stream: files that arrive are checked and written once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from quern.functions.text import squeeze
from quern.operators.validation import structural_reason


def records(spark: SparkSession, folder: str, schema: StructType | str, files_at_once: int = 100) -> DataFrame:
    """JSON-lines files of a folder as a stream, as they arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).json(folder)


def validated(stream: DataFrame) -> DataFrame:
    """The stream with `discard_reason` of the structural rules."""
    return stream.withColumn("discard_reason", structural_reason())


def once(stream: DataFrame, key: str, time: str, within: str = "7 days") -> DataFrame:
    """Each text of `key` once within the watermark of `time`, compared with squeezed white space; later repeats are
    dropped with bounded state."""
    keyed = stream.withWatermark(time, within).withColumn("__key", squeeze(F.col(key)))
    return keyed.dropDuplicatesWithinWatermark(["__key"]).drop("__key")


def write(stream: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Appends the stream to a Parquet folder; the checkpoint makes a restart go on where it stopped."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(**(trigger or {"availableNow": True})).start()
