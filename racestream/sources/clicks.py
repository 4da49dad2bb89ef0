"""Click sources: JSON text with the event time beside it (not inside it)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from racestream.schemas import CLICK_SCHEMA


def read_events(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """The driver's ``events`` table, static or as a file stream."""
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    static = spark.read.parquet(path)
    if not stream:
        return static
    # a file stream reads a folder or a glob; this glob matches exactly the one path
    return spark.readStream.schema(static.schema).parquet(f"{sf_dir.rstrip('/')}/event[s].parquet")


def clicks_from_events(events: DataFrame) -> DataFrame:
    """Clicks derived from ``events``: one JSON body per event.

    ``user.accountId`` (one literal dotted key) is the user id, or -1, the
    anonymous marker, for events of type ``error``; ``page`` is the event type.
    Of every 50 events five have a body that the parser must reject: single
    quotes, a numeric string, a number beyond 32 bits, no JSON, none at all.
    Event time is ``ts``; ``seq`` (the event id) breaks ties.
    """
    account = F.when(F.col("event_type") == "error", F.lit(-1).cast("long")).otherwise(F.col("user_id"))
    good = F.to_json(F.struct(account.alias("user.accountId"), F.col("event_type").alias("page")))
    kind = F.col("event_id") % 50
    body = (F.when(kind == 0, F.lit("{'user.accountId':5}"))
            .when(kind == 1, F.lit('{"user.accountId":"77"}'))
            .when(kind == 2, F.lit('{"user.accountId":3000000000}'))
            .when(kind == 3, F.lit("junk"))
            .when(kind == 4, F.lit(None).cast("string"))
            .otherwise(good))
    return events.select(body.alias("value"), F.col("ts"), F.col("event_id").alias("seq"))


def clicks_in_other_spellings(events: DataFrame) -> DataFrame:
    """The same clicks with bodies that are written in other ways: white space (of all JSON kinds), the keys in
    another order, escaped letters, numbers with an exponent, a nested object. One kind per event id mod 5."""
    clicks = clicks_from_events(events)
    account = F.regexp_extract("value", r'"user\.accountId":(-?\d+)', 1)
    page = F.regexp_extract("value", r'"page":"([^"]*)"', 1)
    good = F.coalesce(F.length(page) > 0, F.lit(False))
    kind = F.col("seq") % 5

    def body(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    other = (F.when(kind == 0, body(' {"user.accountId" :\t', account, ' ,\n "page":  "', page, '" } '))
             .when(kind == 1, body('{"page":"', page, '","user.accountId":', account, '}'))
             .when(kind == 2, body('{"p\\u0061ge":"', page, '",\r\n"user.accountId":', account, '}'))
             .when(kind == 3, body('{"user.accountId":', account, ',"more":{"b":[1, 2 ,{ }],"a":null},"page":"', page, '"}'))
             .otherwise(F.col("value")))
    return clicks.withColumn("value", F.when(good, other).otherwise(F.col("value")))


def read_clicks(spark: SparkSession, path: str, fmt: str = "parquet", stream: bool = False,
                schema=CLICK_SCHEMA, **options) -> DataFrame:
    """Clicks stored as files with columns (value, ts, seq); batch or stream."""
    reader = spark.readStream if stream else spark.read
    reader = reader.schema(schema).format(fmt)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)
