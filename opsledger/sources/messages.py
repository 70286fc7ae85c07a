"""Message streams and the JSON envelope."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsledger.model import DEAD_LETTER_BYTES, UNKNOWN_EVENT

_ENVELOPE = "array<struct<event_type:string,payload:string>>"
_PAYLOAD = "map<string,string>"
# White space of JSON; other blanks are part of a text.
_BLANKS = " \t\n\r"
_TEXT_PAYLOAD = r'"payload"\s*:\s*"\s*\{'


def stream_messages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Message files, one body per line.

    ``max_files`` is the flow control: so many files at most per micro-batch. By
    default a micro-batch takes all that is there, and reads it in parallel.
    """
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path).withColumnRenamed("value", "body")


def stream_messages_kafka(
    spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None
) -> DataFrame:
    """Message bodies of a Kafka topic; needs the Kafka package on the classpath."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
    )
    if max_offsets is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return (
        reader.load()
        .select(
            F.col("key").cast("string").alias("routing_key"),
            F.col("value").cast("string").alias("body"),
            F.col("timestamp").alias("ts"),
        )
    )


def decode_messages(messages: DataFrame, body: str = "body") -> DataFrame:
    """Add ``decoded``, ``event_type`` and ``payload`` (a map of texts).

    A missing or null type becomes ``unknown``, a missing payload an empty map.
    ``decoded`` is false for anything that is not exactly one JSON object, and for a
    payload that is neither missing, null nor an object. The body is parsed as the
    only element of an array, so that text after the object makes the whole body
    invalid instead of being ignored.
    """
    text = F.btrim(F.col(body), F.lit(_BLANKS))
    parsed = F.from_json(
        F.concat(F.lit("["), text, F.lit("]")), _ENVELOPE, {"allowSingleQuotes": "false"}
    )
    # A text that holds an object reads like one; only such bodies are looked at twice.
    inner = F.try_variant_get(F.try_parse_json(text), "$.payload", "map<string,variant>")
    is_object = F.when(text.rlike(_TEXT_PAYLOAD), inner.isNotNull()).otherwise(F.lit(True))

    def fields(envelope):
        first = F.try_element_at(envelope, F.lit(1))
        valid = F.coalesce(
            (F.size(envelope) == 1)
            & first.isNotNull()
            & text.endswith("}")
            & (first["payload"].isNull() | (first["payload"].startswith("{") & is_object)),
            F.lit(False),
        )
        payload = F.from_json(first["payload"], _PAYLOAD)
        return F.struct(
            valid.alias("decoded"),
            F.when(valid, F.coalesce(first["event_type"], F.lit(UNKNOWN_EVENT))).alias("event_type"),
            F.when(valid, F.coalesce(payload, F.create_map().cast(_PAYLOAD))).alias("payload"),
        )

    # Generated columns are computed once; filters on them do not repeat the parse.
    return messages.select("*", F.inline(F.transform(F.array(parsed), fields)))


def good_messages(decoded: DataFrame, body: str = "body") -> DataFrame:
    return decoded.where("decoded").drop("decoded", body)


def dead_letters(decoded: DataFrame, body: str = "body") -> DataFrame:
    """Whole bodies that could not be decoded, and ``body_head``, the part that logs show."""
    return (
        decoded.where("NOT decoded")
        .withColumn("body_head", F.substring(body, 1, DEAD_LETTER_BYTES))
        .drop("decoded", "event_type", "payload")
    )


def encode_events(events: DataFrame, event_type: str = "event_type", payload: str = "payload") -> DataFrame:
    """Add ``body``, the JSON envelope, and ``routing_key``, which is the event type."""
    envelope = F.struct(F.col(event_type).alias("event_type"), F.col(payload).alias("payload"))
    return events.withColumn(
        "body", F.to_json(envelope, {"ignoreNullFields": "false"})
    ).withColumn("routing_key", F.col(event_type))
