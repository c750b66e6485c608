"""JSON messages: schemas, decoding, stream sources and sinks.

The source format is a parameter. Kafka needs its connector on the class path; the
file source reads the same JSON lines from a folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from terravane.operators.dedup import ORDINAL

CORRUPT = "_corrupt"


def _text(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


POST_SCHEMA = T.StructType(_text("author", "created_at", "text"))

ENRICHED_SCHEMA = T.StructType([
    *_text("created_at", "city", "assessment"),
    T.StructField("score", T.DoubleType()),
    *_text("text"),
])

# Posts and heartbeats share one topic and are told apart by message_type.
FORUM_SCHEMA = T.StructType([
    *_text("message_type", "subreddit", "id", "title"),
    T.StructField("score", T.LongType()),
    T.StructField("num_comments", T.LongType()),
    T.StructField("created_utc", T.DoubleType()),
    *_text("created_iso", "url", "selftext", "author", "fetch_time_utc"),
    *_text("producer_id", "timestamp_iso", "status"),
    T.StructField("random_val", T.LongType()),
])


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType,
                    ordinal: bool = False) -> DataFrame:
    """JSON Lines as a batch; blank lines are skipped, broken ones give NULLs.

    ``ordinal`` adds the landed order: by the time a file was written, then its lines. The
    parts of one write share the time of the first one done and follow by part number, as
    parallel tasks end in any order.
    """
    scan = spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)
    if not ordinal:
        return scan
    number = F.regexp_extract(F.col("_metadata.file_path"), r"/part-(\d+)-[^/]*$", 1)
    placed = scan.withColumn(ORDINAL, F.struct(
        F.col("_metadata.file_modification_time").alias("written"),
        F.when(number != "", number.try_cast("bigint")).alias("part"),  # as a number: it may have six digits
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row")))
    order = F.col(ORDINAL)
    first = _first_written(spark, path)  # one row per file, broadcast if they are few
    return placed.join(first, order["file"] == F.col("_file"), "left").withColumn(
        ORDINAL, order.withField("written", F.coalesce("_first", order["written"]))
    ).drop("_file", "_first")


def _first_written(spark: SparkSession, path: str) -> DataFrame:
    """(_file, _first): when the first file of the write that a file is of was done.

    Spark puts one id of a write into the names of its parts; other files stand for themselves.
    No content is read.
    """
    files = spark.read.format("binaryFile").load(path).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_modification_time").alias("_written"))
    write = F.regexp_extract("_file", r"/part-\d+-([0-9a-f-]{36})[^/]*$", 1)
    same = Window.partitionBy(F.when(write == "", F.col("_file")).otherwise(write))
    return files.select("_file", F.min("_written").over(same).alias("_first"))


def kafka_options(topic: str, servers: str, group: str | None = None,
                  fail_on_data_loss: bool = True) -> dict[str, str]:
    """Reader options. Expired offsets stop the query unless that is switched off."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "latest",
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    return options | ({"kafka.group.id": group} if group else {})


def message_stream(spark: SparkSession, source: str, files_per_trigger: int | None = None,
                   **options) -> DataFrame:
    """Streaming frame with one text column ``value``.

    ``source`` is ``"kafka"`` (see ``kafka_options``) or a folder of JSON Lines files.
    """
    reader = spark.readStream
    if source == "kafka":
        return reader.format("kafka").options(**options).load().select(
            F.col("value").cast("string").alias("value"))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.options(**options).text(source)


def decode(messages: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Typed columns plus ``_raw`` and ``_corrupt``; messages of white space only are dropped.

    ``_corrupt`` holds the message if it is not a JSON object. A field of another type than
    the schema's is NULL, and the message stays.
    """
    parsed = F.from_json(F.col(value), schema, {"mode": "PERMISSIVE"})
    is_object = F.from_json(F.col(value), "map<string,string>").isNotNull()
    return (
        messages.filter(F.col(value).rlike(r"\S"))
        .select(F.col(value).alias("_raw"), parsed.alias("_m"),
                F.when(~is_object, F.col(value)).alias(CORRUPT))
        .select("_raw", "_m.*", CORRUPT)
    )


def well_formed(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def rejected(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("value"))


def of_type(messages: DataFrame, message_type: str) -> DataFrame:
    return messages.filter(F.col("message_type") == message_type)


def as_line(raw: Column | str = "_raw") -> Column:
    """A JSON text on one line. Raw line breaks occur only between JSON tokens."""
    raw = F.col(raw) if isinstance(raw, str) else raw
    return F.regexp_replace(raw, r"[\r\n]+", " ")


def land_messages(decoded: DataFrame, path: str, checkpoint: str,
                  name: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Append every well-formed message unchanged, so fields outside the schema survive."""
    lines = well_formed(decoded).select(as_line().alias("value"))
    return start(lines, "text", path, checkpoint, name, trigger)


def start(df: DataFrame, file_format: str, path: str, checkpoint: str,
          name: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Append a stream to files; the checkpoint makes each row land exactly once."""
    writer = (df.writeStream.format(file_format).outputMode("append")
              .option("checkpointLocation", checkpoint))
    writer = writer.queryName(name) if name else writer
    return writer.trigger(**(trigger or {"processingTime": "1 second"})).start(path)


def as_kafka_values(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct("*")).alias("value"))


def kafka_sink_options(topic: str, servers: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.retries": "5",
    }
