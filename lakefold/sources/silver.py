"""Silver tables on plain parquet.

A parquet path cannot be overwritten while it is being read.  A flat
``SilverTable`` therefore writes each new state to a fresh ``v=<n>/`` folder
and then adds a one-line state file that names it; readers follow the state
file with the highest number.  A state file appears whole or not at all (it
is written under another name and renamed), so a job that dies while saving
leaves the state before.  The folder of a partitioned table is ordinary
partitioned parquet: a merge reads the partitions that its batch touches, stages the
result and replaces just these partitions through Spark's dynamic partition
overwrite, so the others keep their files.

One writer at a time.  A replace of several partitions is not atomic: a
reader may see some of them new and others old, and a job that dies in
between is to be run again (merges are repeatable for rows with full keys).
There is no log, no concurrency control and no time travel; where Delta Lake
is installed, ``sources.delta`` hands merges to it instead.

The state file also holds, per streaming checkpoint, the last micro-batch
applied, which makes ``foreachBatch`` replays idempotent.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakefold.operators.evolve import conform, merge_schemas, readable_as
from lakefold.session import delete_path, plain_path, stage, staging

#: Folder of the state files, and how many are kept.
_STATE, _KEPT_STATES = "_state", 2


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def key_bucket(keys: list[str], buckets: int) -> Column:
    """Hash bucket of a merge key, as a partition column for tables whose
    keys carry no date.  Null key parts count as values."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


class SilverTable:
    """A mutable table addressed by path.

    ``partition_by`` columns must be functions of the merge key, so that a
    key never spans partitions."""

    def __init__(self, spark: SparkSession, path: str, partition_by: list[str] | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.partition_by = list(partition_by or [])
        jvm = spark.sparkContext._jvm
        self._path = lambda *parts: jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))
        self._fs = self._path().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # -- state ----------------------------------------------------------------
    def _state_files(self) -> list[str]:
        """Names of the complete state files, the newest last."""
        folder = self._path(_STATE)
        if not self._fs.exists(folder):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(folder)]
        return sorted(n for n in names if n.endswith(".json") and n[0].isdigit())

    def _state(self) -> dict:
        files = self._state_files()
        if not files:
            return {}
        stream = self._fs.open(self._path(_STATE, files[-1]))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _save_state(self, state: dict) -> None:
        files = self._state_files()
        new = f"{int(files[-1].split('.')[0]) + 1 if files else 1:012d}.json"
        unfinished = self._path(_STATE, f"new-{uuid.uuid4().hex}")
        out = self._fs.create(unfinished, False)
        try:
            out.write(bytearray(json.dumps(state).encode()))
        finally:
            out.close()
        if not self._fs.rename(unfinished, self._path(_STATE, new)):
            raise RuntimeError(f"another writer saved state {new} of {self.path}")
        for old in (files + [new])[:-_KEPT_STATES]:
            self._fs.delete(self._path(_STATE, old), False)

    def exists(self) -> bool:
        return bool(self._state())

    def applied(self, writer: str) -> int | None:
        """Last batch id that ``writer`` (a checkpoint) has applied."""
        return self._state().get("applied", {}).get(writer)

    # -- read -----------------------------------------------------------------
    def location(self) -> str:
        """Folder of the current data."""
        state = self._state()
        if not state:
            raise FileNotFoundError(f"no table under {self.path}")
        return f"{self.path}/{state['folder']}"

    def read(self, partitions: list[tuple] | None = None) -> DataFrame:
        """The current table; ``partitions`` (values in ``partition_by``
        order) restricts the read to these partitions."""
        state = self._state()
        if not state:
            raise FileNotFoundError(f"no table under {self.path}")
        schema = T.StructType.fromJson(state["schema"])
        df = self.spark.read.schema(schema).parquet(f"{self.path}/{state['folder']}").select(*schema.fieldNames())
        return df if partitions is None else df.filter(self._any_of(partitions))

    def _any_of(self, values: list[tuple]) -> Column:
        """Predicate on the partition columns (prunes folders)."""
        if len(self.partition_by) == 1:
            own = [v[0] for v in values]
            known = F.col(self.partition_by[0]).isin([v for v in own if v is not None])
            return (known | F.col(self.partition_by[0]).isNull()) if None in own else known
        out = F.lit(False)
        for v in values:
            one = F.lit(True)
            for c, x in zip(self.partition_by, v):
                one = one & F.col(c).eqNullSafe(F.lit(x))
            out = out | one
        return out

    def partition_values(self, df: DataFrame) -> list[tuple]:
        """Distinct partition values of ``df``: as many as the partition
        columns can take, which must be bounded (hash buckets, months)."""
        return [tuple(r) for r in df.select(*self.partition_by).distinct().collect()]

    # -- write ----------------------------------------------------------------
    def write(self, df: DataFrame, applied: tuple[str, int] | None = None) -> None:
        """K1: ``df`` becomes the whole table (columns may evolve).  Rows are
        rebalanced before the write, so file sizes follow the advisory
        partition size instead of the upstream partitioning.  ``applied``
        records a streaming batch as (writer, batch id)."""
        self.recover()
        state = self._state()
        folder = f"v={uuid.uuid4().hex[:12]}"
        out = df.hint("rebalance", *self.partition_by) if self.partition_by else df.hint("rebalance")
        writer = out.write.partitionBy(*self.partition_by) if self.partition_by else out.write
        writer.parquet(f"{self.path}/{folder}")
        self._commit(state, applied, folder=folder, previous=state.get("folder"), schema=_nullable(df.schema).jsonValue())
        if state.get("previous"):  # the last state stays for readers that have begun
            delete_path(self.spark, f"{self.path}/{state['previous']}")

    def replace(self, df: DataFrame, partitions: list[tuple], applied: tuple[str, int] | None = None) -> None:
        """``df`` becomes the content of ``partitions``; the files of other
        partitions stay as they are.  ``df`` may read the table.  Columns and
        nested fields may be added and types may widen (``operators.evolve``);
        where the stored files could not be read in the wider type, the whole
        table is written anew."""
        self.recover()
        state = self._state()
        known = T.StructType.fromJson(state["schema"])
        merged = merge_schemas(known, df.schema)
        df = conform(df, merged)
        if not readable_as(known, merged):
            others = self.read().filter(~F.coalesce(self._any_of(partitions), F.lit(False)))
            self.write(conform(others, merged).unionByName(df), applied)
            return
        with staging(self.spark):
            new = stage(df, "silver-replace", compression="zstd")
            stray = new.filter(~F.coalesce(self._any_of(partitions), F.lit(False))).limit(1)
            if not stray.isEmpty():
                raise ValueError(f"rows outside the partitions to replace: {stray.first()}")
            produced = set(self.partition_values(new))
            data = f"{self.path}/{state['folder']}"
            (new.hint("rebalance", *self.partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(*self.partition_by).parquet(data))
        emptied = [p for p in partitions if p not in produced]
        if emptied:  # a dynamic overwrite leaves partitions without new rows alone
            self._drop(state["folder"], emptied)
        self._commit(state, applied, schema=_nullable(merged).jsonValue())

    def recover(self) -> None:
        """Complete an exchange of files (``sources.compaction``) that a job
        has begun and not finished: new files move in, old ones go."""
        swap = self._state().get("swap")
        if not swap:
            return
        folder = self.location()[len(self.path):].strip("/")
        data = self._path(swap, "data")
        found = self._fs.listFiles(data, True) if self._fs.exists(data) else None
        while found is not None and found.hasNext():
            file = found.next().getPath()
            if file.getName().endswith(".parquet"):
                below = file.getParent().toString().split(f"/{swap}/data", 1)[1].strip("/")
                to = [folder, below] if below else [folder]
                self._fs.mkdirs(self._path(*to))
                if not self._fs.rename(file, self._path(*to, file.getName())):
                    raise RuntimeError(f"{file} could not be moved into the table")
        for r in self.spark.read.parquet(f"{self.path}/{swap}/plan").select("path").toLocalIterator():
            delete_path(self.spark, r.path)
        state = self._state()
        state.pop("swap", None)
        self._save_state(state)
        delete_path(self.spark, f"{self.path}/{swap}")

    def _drop(self, folder: str, partitions: list[tuple]) -> None:
        """Delete partitions by the folders that hold them."""
        schema = T.StructType.fromJson(self._state()["schema"])
        held = (self.spark.read.schema(schema).parquet(f"{self.path}/{folder}").filter(self._any_of(partitions))
                .select(plain_path(F.regexp_extract("_metadata.file_path", r"^(.*)/[^/]+$", 1)).alias("p")).distinct())
        for r in held.collect():  # one row per partition
            delete_path(self.spark, r.p)

    def _commit(self, state: dict, applied: tuple[str, int] | None, **changed) -> None:
        marks = dict(state.get("applied", {}))
        if applied:
            marks[applied[0]] = int(applied[1])
        self._save_state(state | changed | {"applied": marks})

    def open_or_create(self, df: DataFrame) -> DataFrame:
        """The current table, created from ``df`` when none exists yet."""
        if not self.exists():
            self.write(df)
        return self.read()
