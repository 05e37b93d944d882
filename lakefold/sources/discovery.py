"""Discovery of tables in a folder tree.

The tree is listed by Spark; tasks read the schema of every Parquet file
from its footer.  Folder names that are partition values (``name=value`` or
a date) are cut off, and files are counted per remaining folder and schema,
so the driver sees one row per folder and distinct schema, not per file.
There the folders form a trie: the files of a folder are one table where
their schemas merge (``operators.evolve``) and share half of their columns,
else each schema is one; sibling folders that hold the same kind of table
become one table of their parent, with the folder names as a partition
column.  Types of partition columns follow their values: whole number, date,
or text.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakefold.operators.evolve import SchemaMergeError, merge_schemas
from lakefold.session import stage

DATE_FOLDER = r"^\d{4}-\d{2}-\d{2}$"
#: Least share of common columns of two schemas of one table.
COMMON = 0.5


@dataclass
class FoundTable:
    location: str
    schema: T.StructType
    partitions: list[tuple[str, str]] = field(default_factory=list)  # name, type
    n_files: int = 0
    bytes: int = 0

    @property
    def name(self) -> str:
        return self.location.rstrip("/").rsplit("/", 1)[-1].replace("-", "_")


def _footers(files: DataFrame) -> DataFrame:
    """``path`` and ``schema`` (JSON) of Parquet files."""

    def run(batches) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_schema

        from lakefold.sources.logtail import open_fs

        for batch in batches:
            out = []
            for path in batch.column(0).to_pylist():
                filesystem, name = open_fs(path)
                found = pq.read_schema(name, filesystem=filesystem)
                own = (found.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
                out.append(own.decode() if own else from_arrow_schema(found).json())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["path", "schema"])

    return files.select("path").mapInArrow(run, "path string, schema string")


def _qualified(spark: SparkSession, path: str) -> str:
    """A folder as it begins the paths of its files."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()


def _folders(spark: SparkSession, root: str) -> tuple[list, dict]:
    """Rows of (folder without partition values, names of its partition
    levels, schema, files, bytes, first file), and the type of each level."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    files = stage(listed.select("path", F.col("length").alias("bytes")), "discovery-files")
    below = F.expr(f"substring(path, {len(_qualified(spark, root)) + 2})")
    parts = F.slice(F.split(below, "/"), 1, F.greatest(F.size(F.split(below, "/")) - 1, F.lit(0)))
    is_value = lambda x: x.contains("=") | x.rlike(DATE_FOLDER)
    named = files.join(_footers(files), "path").select("path", "bytes", "schema", parts.alias("parts")).withColumns({
        "folder": F.array_join(F.filter("parts", lambda x: ~is_value(x)), "/"),
        "levels": F.transform(F.filter("parts", is_value), lambda x, i: F.struct(
            F.when(x.contains("="), F.substring_index(x, "=", 1)).otherwise(F.concat(F.lit("partition_"), i.cast("string"))).alias("name"),
            F.when(x.contains("="), F.url_decode(F.substring_index(x, "=", -1))).otherwise(x).alias("value")))})
    named = stage(named, "discovery-named")
    rows = named.groupBy("folder", F.transform("levels", lambda x: x["name"]).alias("names"), "schema").agg(
        F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"), F.min("path").alias("first")).orderBy("folder", "first").collect()
    values = named.select("folder", F.explode("levels").alias("l")).filter("l.value <> '__HIVE_DEFAULT_PARTITION__'")
    kinds = values.groupBy("folder", "l.name").agg(
        F.bool_and(F.col("l.value").rlike(r"^-?\d{1,9}$")).alias("whole"), F.bool_and(F.col("l.value").rlike(DATE_FOLDER)).alias("dates"))
    types = {(r.folder, r.name): "int" if r.whole else "date" if r.dates else "string" for r in kinds.collect()}
    return rows, types


def _alike(a: T.StructType, b: T.StructType) -> T.StructType | None:
    """The merged schema of two that belong to one table, else None."""
    one, two = ({f.name.lower() for f in s.fields} for s in (a, b))
    if len(one & two) < COMMON * min(len(one), len(two)):
        return None
    try:
        return merge_schemas(a, b)
    except SchemaMergeError:
        return None


def _without(schema: T.StructType, names: list[str]) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name not in names])


def discover(spark: SparkSession, root: str) -> list[FoundTable]:
    """The tables below ``root``, by location."""
    root = root.rstrip("/")
    rows, types = _folders(spark, root)
    found: dict[str, list[FoundTable]] = {}
    for r in rows:
        schema = T.StructType.fromJson(json.loads(r.schema))
        levels = [(n, types.get((r.folder, n), "string")) for n in r.names]
        for t in found.setdefault(r.folder, []):
            merged = _alike(t.schema, schema) if t.partitions == levels else None
            if merged is not None:
                t.schema, t.n_files, t.bytes = merged, t.n_files + r.n, t.bytes + r.bytes
                break
        else:
            found[r.folder].append(FoundTable(f"{root}/{r.folder}".rstrip("/"), schema, levels, r.n, r.bytes))
    for folder in sorted({f.rsplit("/", 1)[0] for f in found if "/" in f}, key=lambda f: -f.count("/")):
        inner = [f for f in found if f.rsplit("/", 1)[0] == folder and "/" in f]
        tables = [t for f in inner for t in found[f]]
        if folder in found or len(inner) < 2 or len(tables) != len(inner) or len({tuple(t.partitions) for t in tables}) > 1:
            continue
        merged: T.StructType | None = tables[0].schema
        for t in tables[1:]:
            merged = _alike(merged, t.schema) if merged else None
        if merged:
            level = (f"partition_{len(tables[0].partitions)}", "string")
            found[folder] = [FoundTable(f"{root}/{folder}", merged, [level, *tables[0].partitions], sum(t.n_files for t in tables), sum(t.bytes for t in tables))]
            for f in inner:
                del found[f]
    return sorted((t for ts in found.values() for t in ts), key=lambda t: t.location)


def register_found(spark: SparkSession, t: FoundTable, name: str) -> DataFrame:
    """Register a found table in the catalog, with every partition folder."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _without(t.schema, [n for n, _ in t.partitions]).fields)
    levels = ", ".join(f"`{n}` {kind}" for n, kind in t.partitions)
    place = t.location.replace("'", "\\'")
    by = f" PARTITIONED BY ({', '.join(f'`{n}`' for n, _ in t.partitions)})" if t.partitions else ""
    spark.sql(f"CREATE TABLE {name} ({', '.join(x for x in (columns, levels) if x)}) USING parquet{by} LOCATION '{place}'")
    if t.partitions and all(not n.startswith("partition_") for n, _ in t.partitions):
        spark.catalog.recoverPartitions(name)
    elif t.partitions:  # folders that do not say their column's name: one statement per folder
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(t.location)
        for r in listed.select(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("p")).distinct().orderBy("p").toLocalIterator():
            own = r.p[len(_qualified(spark, t.location)) + 1:].split("/")[-len(t.partitions):]
            values = ", ".join(f"`{n}` = '{x.split('=', 1)[-1]}'" for (n, _), x in zip(t.partitions, own))
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({values}) LOCATION '{r.p}'")
    spark.catalog.refreshTable(name)
    return spark.table(name)
