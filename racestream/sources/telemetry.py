"""Telemetry sources: opaque messages in the Kafka source's layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from racestream.options import TelemetryOptions

TOPIC = "f1-telemetry-drivers"


def read_kafka(spark: SparkSession, opts: TelemetryOptions, stream: bool = True) -> DataFrame:
    """The telemetry topic, from the earliest offset by default.

    Needs the Spark Kafka connector on the classpath; the payload is passed on
    untouched (``value`` stays binary until ``decode_telemetry``).
    """
    if not opts.bootstrap_servers:
        raise ValueError("TelemetryOptions.bootstrap_servers is required for the Kafka source")
    reader = spark.readStream if stream else spark.read
    reader = (reader.format("kafka")
              .option("kafka.bootstrap.servers", opts.bootstrap_servers)
              .option("subscribe", opts.topic)
              .option("startingOffsets", opts.starting_offsets))
    if stream and opts.max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", opts.max_offsets_per_trigger)
    for k, v in opts.kafka_options.items():
        reader = reader.option(k, v)
    try:
        return reader.load()
    except Exception as exc:  # the connector jar is optional
        if "kafka" in str(exc).lower() and "data source" in str(exc).lower():
            raise RuntimeError(
                "the Kafka source needs the spark-sql-kafka connector on the classpath; "
                "files in the Kafka layout can be read with read_kafka_files") from exc
        raise


def read_kafka_files(spark: SparkSession, path: str, stream: bool = False, fmt: str = "parquet",
                     schema=None, **options) -> DataFrame:
    """Messages in the Kafka layout stored as files (tests, replays)."""
    reader = spark.readStream if stream else spark.read
    if schema is None:
        schema = spark.read.format(fmt).load(path).schema
    reader = reader.schema(schema).format(fmt)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


def _k(props: str = "props"):
    return F.get_json_object(F.col(props), "$.k").cast("int")


def _quoted(c):
    # JSON string of a value without quotes or escapes (dates, ids, event types).
    return F.concat(F.lit('"'), c, F.lit('"'))


def kafka_layout_from_events(events: DataFrame, topic: str = TOPIC) -> DataFrame:
    """Telemetry messages derived from ``events`` (one per event).

    The JSON body carries one car's state: session = the event's date, driver =
    ``DRIVER_nn`` with nn = user id mod 20, position = k mod 21 (k from
    ``props``), lap = 1 + hour, lap distance = 10 x value (one decimal), speed =
    3k, fuel = k, fuel laps = k mod 10, lateral g = value / 100 (four decimals),
    longitudinal g = its negative. Events with k = 0 become undecodable
    messages of nine kinds (null, empty, junk, ``{}``, no driver id, a position
    that is text, too large or a fraction, single quotes), which the decoder
    must drop. The topic has three partitions: event id mod 3, with the
    offset = event id div 3 counted in each; ``timestamp`` is the event time cut
    to the hour, so times tie within and across partitions.
    """
    src = events.select("event_id", "ts", "user_id", "event_type", "value", _k().alias("k"))
    k = F.col("k")
    user = F.col("user_id")
    val = F.col("value")

    def dec(c, scale):
        # fixed-point text of a double (no exponent, no negative zero)
        return c.cast(f"decimal(18,{scale})").cast("string")

    fields = [
        ("session_id", _quoted(F.col("ts").cast("date").cast("string"))),
        ("driver_id", _quoted(F.concat(F.lit("DRIVER_"), F.lpad((user % 20).cast("string"), 2, "0")))),
        ("race_number", (user % 20).cast("string")),
        ("driver_status", _quoted(F.col("event_type"))),
        ("car_position", (k % 21).cast("string")),
        ("current_lap_num", (F.hour("ts") + 1).cast("string")),
        ("lap_distance", dec(val * 10, 1)),
        ("speed", (k * 3).cast("string")),
        ("fuel_in_tank", k.cast("string")),
        ("fuel_remaining_laps", (k % 10).cast("string")),
        ("g_force_lateral", dec(val / 100, 4)),
        ("g_force_longitudinal", dec(-(val / 100), 4)),
    ]
    parts = [F.lit("{")]
    for i, (name, text) in enumerate(fields):
        parts += [F.lit(("," if i else "") + f'"{name}":'), text]
    parts.append(F.lit("}"))
    good = F.concat(*parts)
    no_driver = F.concat(F.lit('{"session_id":'), fields[0][1], F.lit("}"))
    kind = F.col("event_id") % 9

    def with_position(text):
        return F.concat(F.lit('{"session_id":'), fields[0][1], F.lit(',"driver_id":"DRIVER_07","car_position":' + text + "}"))

    bad = (F.when(kind == 0, F.lit(None).cast("string"))
           .when(kind == 1, F.lit(""))
           .when(kind == 2, F.lit("bad"))
           .when(kind == 3, F.lit("{}"))
           .when(kind == 4, with_position('"abc"'))
           .when(kind == 5, with_position("70000"))
           .when(kind == 6, with_position("2.5"))
           .when(kind == 7, F.lit("{'driver_id':'DRIVER_07','car_position':3}"))
           .otherwise(no_driver))
    body = F.when(k == 0, bad).otherwise(good)
    return src.select(
        F.lit(None).cast("binary").alias("key"),
        body.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        (F.col("event_id") % 3).cast("int").alias("partition"),
        F.floor(F.col("event_id") / 3).alias("offset"),
        F.date_trunc("hour", "ts").cast(events.schema["ts"].dataType).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
