"""Delimited text with rows that cannot be read: kept apart, with their file and the reason.

The accepted and the rejected rows are filters on one parse of the files, so that every line is in exactly
one of them.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Holds a line that does not fit the schema as it stands in the file; null for all others.
REJECTED = "_rejected_record"
WRONG_NUMBER = "wrong number of fields"


class Checked(NamedTuple):
    """``accepted`` has the schema's columns; ``rejected`` has ``file, record, reason``."""

    accepted: DataFrame
    rejected: DataFrame


def text_schema(spark: SparkSession, path: str) -> T.StructType:
    """The header's columns, all as text: for files whose columns are not known beforehand."""
    return spark.read.option("header", True).csv(path).schema


def read_flagged_csv(spark: SparkSession, path: str, schema: T.StructType | str, **options) -> DataFrame:
    """Every line after the headers, with ``REJECTED``; a line that cannot be read has what could be.

    Headers must name the schema's columns in their order: a file that does not ends the job.
    """
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    flagged = T.StructType([*wanted.fields, T.StructField(REJECTED, T.StringType())])
    read = (
        spark.read.schema(flagged)
        .options(
            header=True, enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord=REJECTED
        )
        .options(**options)
        .csv(path)
    )
    # The reader only looks at the columns that are asked for, and so would find fewer faults for fewer
    # columns: the flag asks for them all.
    fields = F.concat_ws("", *(F.col(f.name).cast("string") for f in wanted.fields))
    return read.withColumn(REJECTED, F.when(F.length(fields) >= 0, F.col(REJECTED)))


def _reason(schema: T.StructType, options: dict) -> Column:
    """The first column with a text that is no value of its type; else the number of fields is wrong."""
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    delimiter = options.get("sep", options.get("delimiter", ","))
    spelled = F.from_csv(F.col(REJECTED), texts.simpleString()[7:-1].replace(":", " "), {"sep": delimiter})
    reason = F.lit(WRONG_NUMBER)
    for field in reversed(schema.fields):
        if not isinstance(field.dataType, T.StringType):
            unread = spelled[field.name].isNotNull() & F.col(field.name).isNull()
            text = f"{field.name} is not of type {field.dataType.simpleString()}"
            reason = F.when(unread, text).otherwise(reason)
    return reason


def divided(flagged: DataFrame, **options) -> Checked:
    """Accepted and rejected rows of a frame of ``read_flagged_csv``, or of one written from it.

    A line with fields missing or left over is rejected for that even if a value cannot be read either,
    unless that value comes first in the schema's order.
    """
    columns = [f for f in flagged.schema.fields if f.name not in (REJECTED, "_file")]
    schema = T.StructType(columns)
    file = F.col("_file") if "_file" in flagged.columns else F.col("_metadata.file_name")
    fits = F.col(REJECTED).isNull()
    accepted = flagged.filter(fits).select(*(f.name for f in columns))
    rejected = flagged.filter(~fits).select(
        file.alias("file"), F.col(REJECTED).alias("record"), _reason(schema, options).alias("reason")
    )
    return Checked(accepted, rejected)


def read_checked_csv(spark: SparkSession, path: str, schema: T.StructType | str, **options) -> Checked:
    """Both kinds of rows of delimited text with a header, lazily."""
    return divided(read_flagged_csv(spark, path, schema, **options), **options)
