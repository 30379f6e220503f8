"""Change topics of a message broker as a stream. Needs the broker connector on the classpath."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tidelake.schemas import ENTITIES

MAX_RECORDS_PER_TRIGGER = 50_000


def topics(prefix: str = "shop.public", entities: Iterable[str] = tuple(ENTITIES)) -> list[str]:
    return [f"{prefix}.{name}" for name in entities]


def kafka_options(
    servers: str,
    subscribe: Iterable[str],
    group: str = "bronze-consumer-group",
    max_records: int | None = MAX_RECORDS_PER_TRIGGER,
    skip_missing: bool = True,
) -> dict[str, str]:
    """Start at the earliest offset, bound each trigger (over all topics) where asked to, and go on
    after lost data unless told to stop there."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(subscribe),
        "startingOffsets": "earliest",
        "kafka.group.id": group,
        **({"maxOffsetsPerTrigger": str(max_records)} if max_records else {}),
        "failOnDataLoss": str(not skip_missing).lower(),
    }


def read_topics(spark: SparkSession, servers: str, subscribe: Iterable[str], **options) -> DataFrame:
    return spark.readStream.format("kafka").options(**kafka_options(servers, subscribe, **options)).load()
