"""Publishing records to a topic (K7): keyed, contract-checked JSON values.

``to_records`` is the data part (message key, contract check, JSON value)
and runs anywhere; ``publish`` needs the Spark Kafka connector on the
classpath.  Rows failing the contract are never sent: ``strict=True``
raises, as the reference producer fails the task on a bad record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakefold.operators.ingest import split_contract, with_message_key
from lakefold.schemas import Contract


def to_records(df: DataFrame, contract: Contract, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(records, rejected)``: ``records`` has ``key`` (a UUID) and ``value``
    (the contract's fields as a JSON object of strings).  Optional fields
    that are null, or that ``df`` does not have, are written as null."""
    cols = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in contract.fields]
    valid, rejected = split_contract(df.select(*cols), contract.required, coerce=True, strict=strict)
    keyed = with_message_key(valid, "key")
    records = keyed.select("key", F.to_json(F.struct(*contract.fields), {"ignoreNullFields": "false"}).alias("value"))
    return records, rejected


def publish(records: DataFrame, bootstrap_servers: str, topic: str) -> None:
    """Write ``key``/``value`` records to ``topic`` with all-replica acks and
    an idempotent producer."""
    (
        records.write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("kafka.acks", "all")
        .option("kafka.enable.idempotence", "true")
        .option("topic", topic)
        .save()
    )
