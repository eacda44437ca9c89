"""Table input and output."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def filesystem(spark: SparkSession, path: str):
    """Hadoop path and file system, so local folders and object stores work alike."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = filesystem(spark, path)
    return fs.exists(hadoop_path)


def require_paths(spark: SparkSession, paths: Iterable[str], stage: str) -> None:
    absent = [p for p in paths if not exists(spark, p)]
    if absent:
        raise FileNotFoundError(f"{stage} inputs are missing: {', '.join(absent)}")


def absolute(spark: SparkSession, path: str) -> str:
    """``path`` from the root of its file system, without scheme and host."""
    hadoop_path, fs = filesystem(spark, path)
    return fs.makeQualified(hadoop_path).toUri().getPath().rstrip("/")


def is_file(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = filesystem(spark, path)
    return fs.getFileStatus(hadoop_path).isFile()


def remove(spark: SparkSession, path: str) -> None:
    hadoop_path, fs = filesystem(spark, path)
    fs.delete(hadoop_path, True)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Delimited text with a header; all columns are text unless a schema is given."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader).csv(path)


def write_parquet(frame: DataFrame, path: str, single_file: bool = False) -> None:
    """Full refresh of a table; ``single_file`` only for results of bounded size."""
    (frame.coalesce(1) if single_file else frame).write.mode("overwrite").parquet(path)


def write_clustered(frame: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Full refresh of a table in the order of ``keys``, which may be of any number.

    Each file, and each row group in it, holds a narrow range of the keys and tells it in its footer, so
    that a filter on leading keys opens few files and reads the groups that can match.  Ranges are
    Spark's sample of the rows, so a frequent key takes several files and many rare ones share one.
    """
    ranged = frame.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranged.write.mode("overwrite").parquet(path)


def write_json(frame: DataFrame, path: str) -> None:
    """A one-row frame as JSON; decimals and dates become text so nothing is lost."""
    texts = {
        name: F.col(name).cast("string")
        for name, kind in frame.dtypes
        if kind.startswith("decimal") or kind in ("date", "timestamp")
    }
    out = frame.withColumns(texts) if texts else frame
    out.select(*sorted(out.columns)).coalesce(1).write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def with_load_metadata(
    frame: DataFrame, stage: str, loaded_at: datetime, source_file: bool = False
) -> DataFrame:
    """Add ``<stage>_load_timestamp``, and the name of the file each row was read from."""
    extra: dict[str, Any] = {}
    if source_file:
        extra["source_file_name"] = F.col("_metadata.file_name")
    extra[f"{stage}_load_timestamp"] = F.lit(loaded_at).cast("timestamp")
    return frame.withColumns(extra)
