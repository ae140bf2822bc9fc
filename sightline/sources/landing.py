"""Landing of newline-delimited JSON files.

Files are named ``*.bz2`` but may hold plain text. Real bzip2 files are read with the built-in
splittable codec; mis-named plain files with Hadoop's pass-through codec, so neither kind is
ever held whole in memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.functions.keys import url_fingerprint
from sightline.session import materialize

BZIP2_MAGIC = b"BZh"
_PASSTHROUGH = "org.apache.hadoop.io.compress.PassthroughCodec"
_PASSTHROUGH_KEYS = (
    "io.compress.passthrough.extension",
    "org.apache.hadoop.shaded.io.compress.passthrough.extension",
)
POSITION_MASK = (1 << 33) - 1  # monotonically_increasing_id: low 33 bits count rows of a partition


#: Hadoop's names of stores and the names that the file library uses for the same
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss", "gs": "gs", "file": "file", "hdfs": "hdfs",
           "viewfs": "viewfs", "s3": "s3", "abfs": "abfs", "abfss": "abfss"}


def library_uri(uri: str) -> str:
    """A Hadoop path as a URI of the file library; raises for a scheme that is not known."""
    scheme, mark, rest = uri.partition(":")
    if not mark or "/" in scheme:
        return f"file://{uri}"
    if scheme not in SCHEMES:
        raise ValueError(f"files of {scheme}: cannot be opened by tasks: {uri}")
    return f"{SCHEMES[scheme]}:{rest}"


def _sniff(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs

    for frame in frames:
        flags = []
        for uri in frame["path"]:
            system, path = fs.FileSystem.from_uri(library_uri(uri))
            with system.open_input_stream(path, compression=None) as stream:
                flags.append(stream.read(len(BZIP2_MAGIC)) == BZIP2_MAGIC)
        yield pd.DataFrame({"path": frame["path"], "is_bzip2": flags})


def list_landed(spark: SparkSession, path: str) -> DataFrame:
    """Paths of the files of a landing folder; content is not loaded."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.bz2")
        .load(path)
        .select("path")
    )


def _tagged(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.col("value"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )


def land_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank trimmed lines of every landed file, with file and block of origin."""
    return land_files(list_landed(spark, path))


def land_files(files: DataFrame) -> DataFrame:
    """As :func:`land_json_lines`, of the files whose ``path`` is listed.

    The kind of each file is read from its first bytes, by tasks. File names reach the driver, as
    they do for any Spark file listing; a stream of files bounds them by its batch size.
    """
    spark = files.sparkSession
    listed = files.mapInPandas(_sniff, "path string, is_bzip2 boolean").collect()
    packed = [r["path"] for r in listed if r["is_bzip2"]]
    plain = [r["path"] for r in listed if not r["is_bzip2"]]
    parts = []
    if packed:
        parts.append(_tagged(spark.read.text(packed)))
    if plain:
        reader = spark.read.option("io.compression.codecs", _PASSTHROUGH)
        for key in _PASSTHROUGH_KEYS:
            reader = reader.option(key, ".bz2")
        parts.append(_tagged(reader.text(plain)))
    if not parts:
        return spark.createDataFrame([], "value string, file_path string, block_start bigint")
    lines = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return lines.withColumn("value", F.trim("value")).filter(F.col("value") != "")


def json_array_rows(lines: DataFrame) -> DataFrame:
    """One row per JSON value: an array line gives one row per element, other lines one.

    Malformed lines are left out here and returned by :func:`rejected_lines`.
    """

    def rows(parsed: Column) -> Column:
        # a lambda binds the parsed value, so each line is parsed once; a NULL array has no rows
        elements = F.transform(parsed.cast("array<variant>"), lambda v: F.to_json(v))
        several = F.when(F.col("value").startswith("["), elements).otherwise(F.array("value"))
        return F.when(parsed.isNotNull(), several)

    found = F.transform(F.array(F.try_parse_json("value")), rows)[0]
    return lines.withColumn("json_data", F.explode(found)).drop("value")


def rejected_lines(lines: DataFrame) -> DataFrame:
    return lines.filter(F.try_parse_json("value").isNull())


def staging_rows(rows: DataFrame, now: Column) -> DataFrame:
    """Landed rows in staging form, with a gapless 0-based ``record_index`` per file.

    A file may be larger than one task, so rows are counted per (file, block, task) first and
    each row adds its own position: no window over a whole file. The rows are written once to
    the shared folder so that both uses see the same task numbers.
    """
    keys = ["file_path", "block_start", "task"]
    numbered = rows.withColumn("_mid", F.monotonically_increasing_id()).select(
        "*",
        F.shiftright("_mid", 33).alias("task"),
        F.col("_mid").bitwiseAND(F.lit(POSITION_MASK)).alias("position"),
    )
    stored = materialize(numbered.drop("_mid"), "landing")
    blocks = stored.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min("position").alias("first_position")
    )
    # one row per (file, block): the number of blocks of a file is its size over the split size
    before = F.expr(
        "sum(n) over (partition by file_path order by block_start, task, first_position) - n"
    )
    offsets = blocks.withColumn("before", before).drop("n")
    index = F.col("before") + F.col("position") - F.col("first_position")
    name = F.regexp_replace("file_path", r"\.bz2$", "")
    return stored.join(offsets, keys).select(
        "json_data",
        index.cast("int").alias("record_index"),
        name.alias("source_filename"),
        F.col("file_path").alias("blob_name"),
        now.alias("created_timestamp"),
        url_fingerprint(F.get_json_object("json_data", "$.occurrence.creative.url")).alias(
            "creative_url_hash"
        ),
    )
