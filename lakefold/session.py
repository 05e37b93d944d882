"""Session construction and shared-folder helpers.

Settings that change planning (ANSI, AQE, time zone) are fixed here so that
every job and test sees the same semantics.  Launch-time settings (memory,
executor counts, extensions) belong in the builder or in ``spark-submit``;
setting them on a running context has no effect.
"""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid

from contextvars import ContextVar

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Scratch folders made inside the open ``staging`` blocks, the innermost last.
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("lakefold_scratch", default=())

#: Session defaults.  AQE coalesces small shuffle partitions, splits skewed
#: join partitions and converts joins to broadcast from measured sizes.
DEFAULT_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app_name: str = "lakefold",
    master: str | None = None,
    time_zone: str = "UTC",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library's semantics.

    ``time_zone`` is required in spirit: Bronze timestamps arrive as local
    wall-clock text, so the zone that interprets them must be explicit.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.session.timeZone"] = time_zone
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # A reused session keeps its own runtime settings; re-apply the ones
    # that can change at runtime.
    for key in (
        "spark.sql.ansi.enabled",
        "spark.sql.session.timeZone",
        "spark.sql.adaptive.enabled",
        "spark.sql.adaptive.skewJoin.enabled",
    ):
        spark.conf.set(key, conf[key])
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only on a
    local master.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS, S3,
    ...) and is used as is; without it nothing can be staged, since each
    executor would write to its own disk.  On ``local[...]`` (tests) a
    private temporary folder is set when nothing is configured.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError(
                f"spark.checkpoint.dir is not set on {sc.master}: set it to a folder that all executors share"
            )
        configured = tempfile.mkdtemp(prefix="lakefold-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str, kept: bool = False) -> str:
    """A fresh folder under the shared checkpoint folder for intermediate
    tables.  ``kept``: it outlives the current ``staging`` block (but not one
    around that)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/lakefold/{name}-{uuid.uuid4().hex[:12]}"
    scopes = _SCOPES.get()[:-1] if kept else _SCOPES.get()
    if scopes:
        scopes[-1].append(path)
    return path


def read_table(spark: SparkSession, sf_dir: str, name: str):
    """Read one driver table (parquet) by name."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def plain_path(encoded: Column | str) -> Column:
    """The path that a file's URL-encoded ``_metadata.file_path`` stands for
    (a plus sign is a plus sign there)."""
    col = F.col(encoded) if isinstance(encoded, str) else encoded
    return F.url_decode(F.replace(col, F.lit("+"), F.lit("%2B")))


def delete_path(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def stage(df, name: str, kept: bool = False, compression: str | None = None):
    """Write ``df`` as parquet under the shared checkpoint folder and return
    a DataFrame reading it back.

    Used where a frame feeds several actions (guards, joins): the lineage is
    cut once, the copy survives executor loss, and later scans get column
    pruning and file statistics.  ``kept``: see ``scratch_path``.
    ``compression``: a Parquet codec in place of the session's.
    """
    path = scratch_path(df.sparkSession, name, kept)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.parquet(path)


@contextlib.contextmanager
def staging(spark: SparkSession):
    """A scope for scratch folders: everything staged inside the block is
    deleted at its end.  Use it when all that reads the copies finishes
    inside the block, for example a write that commits a table."""
    token = _SCOPES.set((*_SCOPES.get(), []))
    try:
        yield
    finally:
        for path in _SCOPES.get()[-1]:
            delete_path(spark, path)
        _SCOPES.reset(token)
