"""Word rules and Arrow batch settings shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from sightline.session import configure

#: fixed values: a word is a run of anything but these six white-space characters
WHITE = " \t\n\x0b\x0c\r"
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Rows and bytes handed to a Python worker at once, so that long texts do not pile up.
BATCH_ROWS = 2000
BATCH_BYTES = 16 << 20


def prepared(spark: SparkSession) -> SparkSession:
    """The library's session options, and small Arrow batches for text columns."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{folder}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text, in order; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def split_words(text: str | None) -> list[bytes]:
    """The same words, as UTF-8 with A-Z in lower case. ``bytes.split`` uses the same white space."""
    return text.encode().lower().split() if text else []


def with_long_id(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def map_texts(docs: DataFrame, text: str, keep: list[str], make, schema: str | StructType) -> DataFrame:
    """``make(texts, columns) -> list of columns`` over Arrow batches.

    ``make`` gets the texts as strings or None and the kept columns as Arrow arrays; what it
    returns follows ``schema``. Kept columns travel as Arrow, so ids with nulls stay exact.
    """
    target = to_arrow_schema(_parse_datatype_string(schema) if isinstance(schema, str) else schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = {name: batch.column(name) for name in keep}
            made = make(batch.column(text).to_pylist(), kept)
            arrays = [
                c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(made, target, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return docs.select(*keep, F.col(text).cast("string").alias(text)).mapInArrow(run, schema)
