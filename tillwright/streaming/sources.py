"""Message sources and sinks. Kafka in production; files of messages stand in where it is absent."""

from __future__ import annotations

from threading import Event, Timer
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules
from .messages import POSITION


# Messages of one micro-batch at most, unless the caller says otherwise: a first start at the earliest
# offset would else take the whole topic at once.
OFFSETS_PER_TRIGGER = 1_000_000


def kafka_options(
    servers: str,
    topic: str = rules.STREAM_TOPIC,
    group: str | None = rules.STREAM_GROUP,
    starting: str = "earliest",
    **options,
) -> dict[str, str]:
    """Reader options; those that are None are left out.

    Useful extras: `maxOffsetsPerTrigger` bounds a micro-batch, `minPartitions` splits a topic
    partition that one busy customer has made long.
    """
    merged = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "kafka.group.id": group,
        **options,
    }
    return {key: str(value) for key, value in merged.items() if value is not None}


def stream_options(servers: str, **options) -> dict[str, str]:
    return kafka_options(servers, **{"maxOffsetsPerTrigger": OFFSETS_PER_TRIGGER, **options})


def probe_options(servers: str, **options) -> dict[str, str]:
    """A bounded read that joins no group: in the stream's own it would take data from the stream."""
    return kafka_options(servers, **{"group": None, **options})


def with_kafka_position(messages: DataFrame) -> DataFrame:
    """Order of delivery: the broker's time across topic partitions, the offset within one."""
    return messages.withColumn(POSITION, F.struct("timestamp", "partition", "offset"))


def kafka_stream(spark: SparkSession, servers: str, **options) -> DataFrame:
    reader = spark.readStream.format("kafka").options(**stream_options(servers, **options))
    return with_kafka_position(reader.load())


def kafka_batch(spark: SparkSession, servers: str, **options) -> DataFrame:
    """What the topic holds now, as a bounded read."""
    reader = spark.read.format("kafka").options(**probe_options(servers, **options))
    return with_kafka_position(reader.load())


def with_file_position(messages: DataFrame) -> DataFrame:
    """Order of delivery: when the file was finished, its path, and the block of it."""
    file = "_metadata.file_{}".format
    return messages.select(
        "value",
        F.struct(
            F.col(file("modification_time")).alias("file_time"), F.col(file("path")).alias("path"),
            F.col(file("block_start")).alias("block"),
        ).alias(POSITION),
    )


def file_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """JSON messages, one per line, from files arriving in a folder."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return with_file_position(reader.load(folder))


def file_batch(spark: SparkSession, folder: str) -> DataFrame:
    return with_file_position(spark.read.text(folder))


def publish_to_kafka(messages: DataFrame, servers: str, topic: str = rules.STREAM_TOPIC) -> None:
    (
        messages.select("key", "value")
        .write.format("kafka")
        .options(**{"kafka.bootstrap.servers": servers, "topic": topic})
        .save()
    )


def probe(messages: DataFrame, sample: int = 10) -> DataFrame:
    """How many of at most `sample` messages a bounded read finds, as one row."""
    return messages.limit(sample).agg(F.count("*").alias("message_count"))


def require_messages(messages: DataFrame, sample: int = 10, seconds: float | None = 5) -> int:
    """The probe's count; fails when there is nothing to read, or no answer in that many seconds.

    A slow probe's own Spark jobs are cancelled; others go on.
    """
    context = messages.sparkSession.sparkContext
    tag = f"probe-{uuid4().hex}"
    late = Event()

    def stop() -> None:
        late.set()
        context.cancelJobsWithTag(tag)

    timer = Timer(seconds, stop) if seconds is not None else None
    context.addJobTag(tag)
    try:
        if timer:
            timer.start()
        found = probe(messages, sample).first()["message_count"]
    except Exception:
        if late.is_set():
            raise TimeoutError(f"no answer from the stream in {seconds} seconds") from None
        raise
    finally:
        if timer:
            timer.cancel()
        context.removeJobTag(tag)
    if found == 0:
        raise RuntimeError("no messages in the stream")
    return found
