"""Event messages: parse, and append to files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# Shape of a message, and the trigger interval of the file sink.
MESSAGE_SCHEMA = "eventType int, location map<string,string>, timestamp long, data string"
TRIGGER_INTERVAL = "60 seconds"


def parse_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """Message bytes or text to columns; works on a batch and on a stream alike.

    ``timestamp`` counts milliseconds; ``date_parsed`` is its text form in the session's time zone. Text that is no
    such message gives nulls.
    """
    parsed = messages.select(F.from_json(F.col(value).cast("string"), MESSAGE_SCHEMA).alias("m")).select("m.*")
    moment = F.from_unixtime((F.col("timestamp") / 1000).cast("long"))
    return parsed.select(
        "eventType",
        "timestamp",
        "data",
        moment.alias("date_parsed"),
        F.col("location")["latitude"].alias("latitude"),
        F.col("location")["longitude"].alias("longitude"),
        F.hour(moment).alias("hour"),
        F.to_date(moment).alias("date"),
    )


def append_to_files(
    parsed: DataFrame,
    path: str,
    checkpoint: str,
    once: bool = False,
) -> StreamingQuery:
    """Append a parsed stream as gzip JSON, partitioned by date and hour.

    ``once`` works off what is there and stops; otherwise a batch starts every minute.
    """
    trigger = {"availableNow": True} if once else {"processingTime": TRIGGER_INTERVAL}
    return (
        parsed.writeStream.format("json")
        .partitionBy("date", "hour")
        .option("compression", "gzip")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )
