"""Loading the supplied tables, and time helpers shared by batch and stream code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"
UTC_NAMES = ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def micros(ts: str | Column) -> Column:
    """Microseconds since 1970-01-01 of a zone-less timestamp, independent of the session zone."""
    t = F.col(ts) if isinstance(ts, str) else ts
    session = SparkSession.getActiveSession()
    zone = session.conf.get("spark.sql.session.timeZone") if session else "UTC"
    if zone in UTC_NAMES:
        return F.timestamp_diff("MICROSECOND", F.expr(EPOCH), t)
    # The difference function reads its arguments in the session zone, whose clock changes would show.
    seconds = F.hour(t) * 3600 + F.minute(t) * 60
    fraction = (F.extract(F.lit("SECOND"), t) * 1_000_000).cast("bigint")
    return F.unix_date(t.cast("date")).cast("bigint") * 86_400_000_000 + seconds.cast("bigint") * 1_000_000 + fraction


def from_micros(us: Column) -> Column:
    return F.timestamp_add("MICROSECOND", us, F.expr(EPOCH))


def with_event_time(df: DataFrame, column: str, delay: str | None = None) -> DataFrame:
    """Zone-less time column to an instant, which watermarks require; optionally watermarked."""
    out = df.withColumn(column, F.col(column).cast("timestamp"))
    return out.withWatermark(column, delay) if delay is not None else out


def zoneless(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def fixed(value: Column | str, scale: int = 2) -> Column:
    """Fixed-point view of a double so that sums do not depend on addition order."""
    value = F.col(value) if isinstance(value, str) else value
    return value.cast(f"decimal(18,{scale})")


def exact_sum(value: Column | str, scale: int = 2) -> Column:
    return F.sum(fixed(value, scale)).cast("double")


def exact_avg(value: Column | str, scale: int = 2) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return exact_sum(value, scale) / F.count(value)
