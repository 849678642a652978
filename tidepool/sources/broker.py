"""Message-broker topics: reader options, decoding of values, and records for writing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions.parsing import STRING_MAP
from tidepool.operators.changelog import is_addition

try:
    from pyspark.sql.avro import functions as avro
except ImportError:  # the avro package is optional
    avro = None


def topic_options(servers: str, topic: str, start: str = "earliest", at_ms: int | None = None,
                  group: str | None = None, max_offsets: int | None = None) -> dict[str, str]:
    """Reader options; ``start`` is earliest, latest, timestamp (with ``at_ms``) or group (resume by checkpoint)."""
    out = {"kafka.bootstrap.servers": servers, "subscribe": topic, "failOnDataLoss": "true"}
    if start in ("earliest", "latest"):
        out["startingOffsets"] = start
    elif start == "timestamp":
        if at_ms is None:
            raise ValueError("start=timestamp needs at_ms")
        out["startingTimestamp"] = str(at_ms)
    elif start == "group":
        # A stream resumes from its checkpoint; the group only names the consumer.
        out["startingOffsets"] = "latest"
        if group is None:
            raise ValueError("start=group needs group")
    else:
        raise ValueError(f"unknown start {start}")
    if group:
        out["kafka.group.id"] = group
    if max_offsets:
        out["maxOffsetsPerTrigger"] = str(max_offsets)
    return out


def read_topic(spark: SparkSession, **options) -> DataFrame:
    """Stream of a topic; needs the connector package on the session's class path."""
    return spark.readStream.format("kafka").options(**topic_options(**options)).load()


def decode_json(df: DataFrame, schema: str, value: str = "value", fail_on_missing: bool = False,
                ignore_errors: bool = False) -> DataFrame:
    """JSON values to columns.

    A broken message fails the job, or is skipped with ``ignore_errors`` (single bad fields become
    null).  With ``fail_on_missing`` an absent field fails the job as well.
    """
    text = F.col(value).cast("string")
    fields = T._parse_datatype_string(schema)
    corrupt = "__corrupt"
    with_corrupt = T.StructType([*fields.fields, T.StructField(corrupt, T.StringType())])
    mode = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt} if ignore_errors else {"mode": "FAILFAST"}
    parsed = F.from_json(text, with_corrupt if ignore_errors else fields, mode)
    rows = df.withColumn("__r", parsed)
    if ignore_errors:
        rows = rows.where(F.from_json(text, STRING_MAP).isNotNull())
    if fail_on_missing:
        keys = F.map_keys(F.from_json(text, STRING_MAP))
        absent = F.array_except(F.lit([f.name for f in fields.fields]), keys)
        rows = rows.withColumn("__r", F.when(F.size(absent) == 0, F.col("__r")).otherwise(
            F.raise_error(F.concat(F.lit("missing fields: "), F.concat_ws(",", absent)))))
    return rows.select(*[F.col("__r")[f.name].alias(f.name) for f in fields.fields])


def decode_csv(df: DataFrame, schema: str, sep: str = ",", value: str = "value") -> DataFrame:
    return df.select(F.from_csv(F.col(value).cast("string"), schema, {"sep": sep}).alias("r")).select("r.*")


def decode_avro(df: DataFrame, avro_schema: str, value: str = "value") -> DataFrame:
    if avro is None:
        raise RuntimeError("the avro package is not on this session's path")
    return df.select(avro.from_avro(F.col(value), avro_schema).alias("r")).select("r.*")


def append_records(df: DataFrame) -> DataFrame:
    """One JSON value per row."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def upsert_records(df: DataFrame, keys: Sequence[str], op: str | None = None) -> DataFrame:
    """Key and value for a compacted topic: JSON key, JSON value without the key fields, null for a delete."""
    rest = [c for c in df.columns if c not in keys and c != op]
    value: Column = F.to_json(F.struct(*rest), {"ignoreNullFields": "false"})
    rows = df
    if op:
        rows = df.where(F.col(op) != "-U")  # the following +U replaces it
        value = F.when(is_addition(op), value)
    return rows.select(F.to_json(F.struct(*keys)).alias("key"), value.alias("value"))


def write_topic(stream: DataFrame, servers: str, topic: str, checkpoint: str):
    """Start writing key/value records to a topic."""
    return (stream.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("checkpointLocation", checkpoint).start())
