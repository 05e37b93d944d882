"""Bronze file readers.

``read_source`` dispatches on format with explicit schemas, so no scan
infers types and every run sees the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT_COL = "_corrupt_record"
FORMATS = ("avro", "csv", "json", "text", "txt", "parquet")


def all_string_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_source(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: T.StructType | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Read Bronze files of one format.

    avro     the embedded schema (needs the spark-avro module on the classpath)
    csv      header row, malformed rows dropped, every column text
    json     PERMISSIVE; unparseable lines kept whole in ``_corrupt_record``
    text|txt one ``value`` column per line
    parquet  the columnar Bronze format used where Avro is not installed

    An unknown format raises ``ValueError`` (the reference returned None).
    """
    fmt = fmt.lower()
    opts = dict(options or {})
    if fmt == "avro":
        reader = spark.read.format("avro").options(**opts)
        return reader.load(path)
    if fmt == "csv":
        # without column pruning a row is malformed whichever columns are read
        reader = spark.read.options(header="true", mode="DROPMALFORMED", columnPruning="false", **opts)
        if schema is not None:
            reader = reader.schema(schema)
        return reader.csv(path)
    if fmt == "json":
        reader = spark.read.options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT_COL, **opts)
        if schema is not None:
            if CORRUPT_COL not in schema.fieldNames():
                schema = T.StructType(schema.fields + [T.StructField(CORRUPT_COL, T.StringType(), True)])
            reader = reader.schema(schema)
        return reader.json(path)
    if fmt in ("text", "txt"):
        return spark.read.options(**opts).text(path)
    if fmt == "parquet":
        reader = spark.read.options(**opts)
        if schema is not None:
            reader = reader.schema(schema)
        return reader.parquet(path)
    raise ValueError(f"unknown source format {fmt!r}; expected one of {FORMATS}")


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good, corrupt)`` rows of a JSON scan; ``good`` has no
    ``_corrupt_record`` column, ``corrupt`` only that one."""
    if CORRUPT_COL not in df.columns:
        return df, df.sparkSession.createDataFrame([], f"{CORRUPT_COL} string")
    bad = F.col(CORRUPT_COL).isNotNull()
    # Spark refuses to read the corrupt column alone; this holds for any row, but needs the others
    others = F.hash(*[c for c in df.columns if c != CORRUPT_COL]) >= F.lit(-(2**31))
    return df.filter(~bad & others).drop(CORRUPT_COL), df.filter(bad & others).select(CORRUPT_COL)


def read_text_lines(spark: SparkSession, path_glob: str) -> DataFrame:
    """Every line of the matching files, with its file path, the first
    byte of the split that it was read in (``block``) and a number that
    ascends within the split (``line_id``)."""
    return spark.read.option("encoding", "UTF-8").text(path_glob).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_id"), F.col("value").alias("line"),
    )


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` rows (the schema travels with the DataFrame)."""
    return df.limit(n)
