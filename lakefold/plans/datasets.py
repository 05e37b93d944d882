"""Dataset plans: transform + merge per Silver table.

One parameterised spec replaces three copies of the same job.  ``run``
is the batch job body: Bronze -> transform -> merge into the current Silver
state (or, on the first run, into a table created from the batch itself,
which is what the reference does: the batch is written, then merged with
itself).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakefold.functions import clean
from lakefold.operators.dedup import distinct_rows, purge_duplicates
from lakefold.operators.hierarchy import label_hierarchy, relabel
from lakefold.operators.joins import key_join
from lakefold.operators.merge import cardinality_errors, latest_per_key, merge
from lakefold.operators.periods import last_days
from lakefold.session import stage, staging
from lakefold.sources.silver import SilverTable, key_bucket

# Silver column lists, keys and refreshed columns per dataset.
NEWS_COLUMNS = ["publish_date", "publisher", "title", "url", "description", "keyword"]
NEWS_KEYS = ["url", "keyword"]

AIR_COLUMNS = [
    "sidoName", "cityName", "cityNameEng", "districtCode", "dataTime",
    "coValue", "no2Value", "o3Value", "pm10Value", "pm25Value", "so2Value",
]
AIR_FLOAT_COLUMNS = ["coValue", "no2Value", "o3Value", "so2Value"]
AIR_KEYS = ["sidoName", "cityName", "dataTime"]
AIR_UPDATE = ["coValue", "no2Value", "o3Value", "pm10Value", "pm25Value", "so2Value"]
AIR_PARTITION = "data_month"

CENSUS_COLUMNS = ["PRD_DE", "C1", "C1_NM", "C1_NM_ENG", "TBL_ID", "DT"]
CENSUS_KEYS = ["PRD_DE", "C1"]
CENSUS_UPDATE = ["C1_NM_SIDO", "C1_NM", "C1_NM_ENG", "TBL_ID", "DT"]
CENSUS_SILVER = [*CENSUS_COLUMNS, "C1_SIDO", "C1_NM_SIDO"]
#: A period has a few hundred rows: a year's periods share a partition.
CENSUS_PARTITION = "period_year"

#: Partitions of the news table: hash buckets of its key, which has no date.
NEWS_PARTITION, NEWS_BUCKETS = "key_bucket", 64
#: Landing day of a Bronze row, and how it travels through a transform.
LANDED, _LANDED = "ingest_date", "__landed"


def _distinct(bronze: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct rows of ``columns``; where Bronze has a landing day, each
    with its last one."""
    if LANDED not in bronze.columns:
        return distinct_rows(bronze, columns)
    return bronze.groupBy(*columns).agg(F.max(LANDED).alias(_LANDED))


def news_transform(bronze: DataFrame, **_) -> DataFrame:
    """Whole-row distinct first (before cleaning, as the reference does, so
    rows that become equal after cleaning are not collapsed again), then the
    keyword and date clean-up."""
    out = _distinct(bronze, [c for c in bronze.columns if c != LANDED]).withColumns(
        {"keyword": clean.keyword("keyword"), "publish_date": clean.parse_date("publish_date")})
    landed = [_LANDED] if _LANDED in out.columns else []
    return out.select(*NEWS_COLUMNS, *landed, key_bucket(NEWS_KEYS, NEWS_BUCKETS).alias(NEWS_PARTITION))


def air_transform(bronze: DataFrame, roll_day: bool = False, **_) -> DataFrame:
    """Project the 11 Silver columns, distinct, float casts, hour-24 fix.
    ``data_month`` (the month of ``dataTime``, a key part) is the partition
    column of the Silver table: hourly readings of one day are too few to
    fill a partition of useful size."""
    projected = _distinct(bronze, AIR_COLUMNS)
    casts = {c: clean.to_float(c) for c in AIR_FLOAT_COLUMNS}
    casts["dataTime"] = clean.hour24_timestamp("dataTime", roll_day=roll_day)
    return projected.withColumns(casts).withColumn(AIR_PARTITION, F.trunc(F.to_date("dataTime"), "MM"))


def census_transform(bronze: DataFrame, top: Callable[[DataFrame], DataFrame] | None = None, **_) -> DataFrame:
    """Project, distinct, period date, int value, top-level label join.  The
    projected rows feed both sides of the join and are staged for it.
    ``top`` gives, for the projected rows, top-level rows known from before."""
    projected = _distinct(bronze, CENSUS_COLUMNS).withColumns(
        {
            "PRD_DE": clean.month_period("PRD_DE"),
            "DT": clean.to_int("DT"),
            "C1_SIDO": clean.code_prefix("C1", 2),
        }
    )
    projected = stage(projected.withColumn(CENSUS_PARTITION, F.year("PRD_DE")), "census-rows")
    return label_hierarchy(projected, top=top(projected) if top else None)


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    keys: list[str]
    transform: Callable[[DataFrame], DataFrame]
    #: "purge" = M5 (delete duplicated keys, insert new); "update" = M1/M2.
    merge_kind: str
    update: list[str] = field(default_factory=list)
    #: Silver partition columns.  Each must be a function of the merge key
    #: (so a key never spans partitions); a run then rewrites only the
    #: partitions its batch touches: months of air readings, years of the
    #: census, hash buckets of the news key (which has no date).
    partition_by: tuple[str, ...] = ()


NEWS = DatasetSpec("news_collection", NEWS_KEYS, news_transform, "purge", [], (NEWS_PARTITION,))
AIR = DatasetSpec("air_quality", AIR_KEYS, air_transform, "update", AIR_UPDATE, (AIR_PARTITION,))
CENSUS = DatasetSpec("census_data_collection", CENSUS_KEYS, census_transform, "update", CENSUS_UPDATE, (CENSUS_PARTITION,))
SPECS = {s.name: s for s in (NEWS, AIR, CENSUS)}


@dataclass(frozen=True)
class RunOptions:
    """``on_conflict="latest"`` keeps, of several rows of a key, the one that
    landed last (Bronze is append-only and read again: a revised value comes
    beside the old one); ``"error"`` raises, as a plain merge does.
    ``roll_day``: hour 24 is hour 0 of the next day, not of the same.
    ``keep_labels``: a census code takes its label from a stored top-level
    row too, and a top-level row that arrives later relabels the stored codes
    below it; without, labels come from the codes' own batch alone."""

    on_conflict: str = "latest"
    roll_day: bool = True
    keep_labels: bool = True


#: The rules of the reference's jobs.
REFERENCE = RunOptions(on_conflict="error", roll_day=False, keep_labels=False)


def merge_batch(spec: DatasetSpec, target: DataFrame, batch: DataFrame) -> DataFrame:
    if spec.merge_kind == "purge":
        return purge_duplicates(target, batch, spec.keys, mode="reference", store=lambda df: stage(df, f"{spec.name}-keys"))
    return merge(target, batch, spec.keys, update=spec.update, insert="all")


def prepare(spec: DatasetSpec, bronze: DataFrame, options: RunOptions, **settings) -> DataFrame:
    """The batch to merge: transformed, one row per key where asked for, and
    staged (it feeds guards and joins)."""
    batch = spec.transform(bronze, roll_day=options.roll_day, **settings)
    if options.on_conflict == "latest" and spec.merge_kind == "update":
        batch = latest_per_key(batch, spec.keys, [_LANDED] if _LANDED in batch.columns else [])
    return stage(batch.drop(_LANDED), f"{spec.name}-batch", compression="zstd")


def fold(spec: DatasetSpec, target: DataFrame | None, batch: DataFrame) -> DataFrame:
    """Merge a transformed batch into ``target``; ``None`` is the first run,
    where the table is created from the batch and the batch is then merged
    into it (keyed rows match themselves, null-key rows are inserted again)."""
    return merge_batch(spec, batch if target is None else target, batch)


def silver_table(spark, spec: DatasetSpec, path: str) -> SilverTable:
    """The Silver table of a dataset, with the dataset's partitioning."""
    return SilverTable(spark, path, partition_by=list(spec.partition_by))


def landed_between(bronze: DataFrame, ref: str, days: int) -> DataFrame:
    """Bronze rows that landed on the ``days`` days before ``ref`` (P8; a
    filter on the landing folders)."""
    return last_days(bronze, LANDED, ref, days)


def _known_top(table: SilverTable) -> Callable[[DataFrame], DataFrame]:
    """Stored top-level rows of the touched partitions that the projected
    rows of a batch do not bring themselves."""

    def known(projected: DataFrame) -> DataFrame:
        stored = table.read(table.partition_values(projected)).filter(F.length("C1") == 2)
        return key_join(stored, projected.select("PRD_DE", "C1"), ["PRD_DE", "C1"], "left_anti").select(
            "PRD_DE", "C1", "C1_NM")

    return known


def _merge_into(spec: DatasetSpec, bronze: DataFrame, table: SilverTable, options: RunOptions,
                applied: tuple[str, int] | None = None) -> None:
    """Transform a batch of Bronze and merge it into the partitions of
    ``table`` that it touches."""
    labels = spec is CENSUS and options.keep_labels and table.exists()
    batch = prepare(spec, bronze, options, **({"top": _known_top(table)} if labels else {}))
    if not table.exists():
        table.write(fold(spec, None, batch), applied)
        return
    touched = table.partition_values(batch) if table.partition_by else None
    merged = fold(spec, table.read(touched), batch)
    if labels:
        merged = relabel(merged, batch)
    if touched is None:
        table.write(merged, applied)
    else:
        table.replace(merged, touched, applied)


def run(spec: DatasetSpec, bronze: DataFrame, table: SilverTable, options: RunOptions = RunOptions()) -> None:
    """R9, the batch job body: transform ``bronze`` and merge it into
    ``table``.  On a partitioned table only the partitions present in the
    batch are read, merged and rewritten.  Staged copies go with the run."""
    with staging(bronze.sparkSession), cardinality_errors():
        _merge_into(spec, bronze, table, options)


def stream_run(spec: DatasetSpec, bronze_stream: DataFrame, table: SilverTable, checkpoint: str,
               options: RunOptions = RunOptions()):
    """T6 for a dataset: every micro-batch of Bronze is transformed and
    merged into ``table`` (only new Bronze files are read, instead of the
    whole feed on every run).  The first micro-batch of a missing table
    follows the first-run rule.  With ``keep_labels`` the labels do not
    depend on the order in which codes and top-level rows arrive.  Returns the
    finished streaming query."""
    from lakefold.streaming.jobs import apply_once

    def apply(batch: DataFrame, applied: tuple[str, int]) -> None:
        with staging(batch.sparkSession):
            _merge_into(spec, batch, table, options, applied)

    return apply_once(bronze_stream, table, checkpoint, apply)
