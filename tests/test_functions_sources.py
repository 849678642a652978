"""Scalar functions, parsers, sources and sinks: input to output."""

from __future__ import annotations

import datetime as dt
import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidepool.functions import parsing as P
from tidepool.functions import registry as R
from tidepool.functions import scalar as S
from tidepool.plans.jobs import gateway_latency, gateway_messages, gateway_records, keyed_log_counts
from tidepool.sources import broker, files, generated, sinks


def one(spark, *columns):
    return list(spark.range(1).select(*columns).first())


def test_time_functions(spark):
    out = one(
        spark,
        F.date_format(F.lit("2023-01-02 03:04:05").cast("timestamp"), "yyyy/MM/dd HH:mm"),
        S.to_timestamp_or_null(F.lit("not a time")),
        S.to_timestamp_or_null(F.lit("03:04"), "HH:mm"),
        S.to_timestamp_or_null(F.lit("2023-02-01T13:27:10.123456+08:00"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"),
        F.unix_timestamp(F.lit("1970-01-02 00:00:00")),
        F.from_unixtime(F.lit(86400)),
        S.from_epoch_ms(F.lit(1500)),
        F.expr("timestampdiff(SECOND, timestamp'2023-01-01 00:00:00', timestamp'2023-01-01 00:01:05')"),
        F.date_format(F.expr("timestamp'2023-01-01 00:00:10' - INTERVAL '3' SECOND"), "mm:ss.SSS"),
    )
    assert out == ["2023/01/02 03:04", None, dt.datetime(1970, 1, 1, 3, 4), dt.datetime(2023, 2, 1, 5, 27, 10, 123456), 86400,
                   "1970-01-02 00:00:00", dt.datetime(1970, 1, 1, 0, 0, 1, 500000), 65, "00:07.000"]


def test_text_and_numeric_functions(spark):
    out = one(
        spark, F.concat_ws("", F.lit("a"), F.lit(None).cast("string"), F.lit("b")), F.md5(F.lit("a")), F.sha2(F.lit("a"), 224),
        F.round(F.lit(1.005), 1), S.divide_or_null(F.lit(1), F.lit(0)), S.distance(F.lit(0), F.lit(0), F.lit(3), F.lit(4)),
        F.lit("x1").try_cast("int"), S.element(F.lit([7, 8]), 1), S.element(F.lit([7, 8]), 5),
        F.expr("map('a', map('b', 3))['a']['b']"), F.expr("regexp_extract('k=v;', '(\\\\w)=(\\\\w)', 2)"),
        F.substring(F.lit("hello"), 2, 3), F.get_json_object(F.lit('{"a":{"b":1}}'), "$.a.b"),
        F.expr("if(map('k', 'v')['z'] IS NOT NULL, 'yes', '')"),
    )
    assert out == ["ab", "0cc175b9c0f1b6a831c399e269772661", "abd37534c7d9a2efb9465de931cd7055ffdb8879563ae98078d6d6d5",
                   1.0, None, 5.0, None, 7, None, 3, "v", "ell", "1", ""]
    assert one(spark, S.stable_int(F.lit("a")) == S.stable_int(F.lit("a")), S.stable_int(F.lit("a")) == S.stable_int(F.lit("b"))) == [True, False]


def test_unnest_and_nested_access(spark):
    df = spark.sql("SELECT map('a', 1, 'b', 2) AS m, array(named_struct('url', 'u1'), named_struct('url', 'u2')) AS snaps")
    assert sorted(tuple(r) for r in df.select(F.explode("m").alias("k", "v")).collect()) == [("a", 1), ("b", 2)]
    assert df.select(S.element("snaps", 1)["url"]).first()[0] == "u1"


def test_line_parsers(spark):
    lines = spark.createDataFrame([("1, keyA , 1676101001, 10.0",), ("too,few",), ("x,keyB,5,y",)], "l string")
    got = [tuple(r.e) if r.e else None for r in lines.select(P.event_line("l").alias("e")).collect()]
    assert got == [(1, "keyA", 1676101001000, 10.0), None, (None, "keyB", 5000, None)]
    values = spark.createDataFrame([("12",), (" 3.5 ",), ("abc",), (None,)], "v string")
    assert [tuple(r.b) for r in values.select(P.best_effort("v").alias("b")).collect()] == [
        ("int", 12, None, None), ("double", None, 3.5, None), ("string", None, None, "abc"), (None, None, None, None)]
    js = spark.createDataFrame([('[{"a":1},{"a":2}]',), ('{"a":3}',), ("",)], "l string")
    assert [r.e for r in js.select(F.explode(P.json_elements("l")).alias("e")).collect()] == ['{"a":1}', '{"a":2}', '{"a":3}']
    raw = spark.createDataFrame([('{"a":1}',), ("oops",)], "l string")
    got = [r.m for r in raw.select(P.json_or_line("l", F.lit("now")).alias("m")).collect()]
    assert got == [{"a": "1", "arrival_time": "now"}, {"line": "oops", "arrival_time": "now"}]


def test_log_groups(spark):
    # Fixed value: a sample line with its known fields.
    log = ("2022-05-17T04:09:02.487660Z [Note] TransformInfo:20230201132710||201000042022039349092393||EXZCash||BR2580019||"
           "10000.00||27||0000||192.168.110.152||xyz")
    names = ["at", "trade_id", "kind", "branch", "amount", "n", "code", "ip", "rest", "none"]
    df = spark.createDataFrame([(log,)], "log string")
    got = df.select(*P.delimited_group("log", r"^(.*)Z \[\w+\] TransformInfo:(.*)$", 2, r"\|\|", names)).first()
    assert list(got) == ["20230201132710", "201000042022039349092393", "EXZCash", "BR2580019", "10000.00", "27", "0000",
                         "192.168.110.152", "xyz", None]


# Two invented messages in the format that the parser reads; the type names are fixed values.
GATEWAY = [
    {"msgId": "up", "message": '2024-03-02 08:10:20.500000 msg : [msg_no:7]<Ext:<shop="3"|>colour="red"|>'
     'PktUpIoReserve:<agw_seq_id=4711|agw_user="first"|agw_user="last"|flag|>\n',
     "@timestamp": "2024-03-02T08:10:21.750000Z", "offset": 109, "source": "/log/a.txt"},
    {"msgId": "down", "message": '2024-03-02 08:10:24.100000 msg : [msg_no:8]<Ext:<a=1|>PktDownIo:<agw_seq_id=4711|n=2|>\n',
     "@timestamp": "2024-03-02T08:10:24.350000Z", "offset": 110, "source": "/log/a.txt"},
]


def test_gateway_job(spark):
    lines = spark.createDataFrame([(json.dumps(GATEWAY),), (json.dumps(GATEWAY[0]),)], "value string")
    records = gateway_records(lines).orderBy("offset").collect()
    assert [(r.msg_type, r.collect_latency, r.agw_seq_id, r.offset, r.source) for r in records] == [
        ("PktUpIoReserve", 1250000, "4711", 109, "/log/a.txt")] * 2 + [("PktDownIo", 250000, "4711", 110, "/log/a.txt")]
    assert records[0].others["agw_user"] == '"last"' and records[0].others["msgId"] == "up" and "offset" not in records[0].others
    out = gateway_latency(gateway_records(lines)).collect()
    assert [(r.cnt, r.max_latency) for r in out] == [(3, 1250000)]
    lists = gateway_messages(gateway_records(lines), max_items=2).collect()
    assert sorted(m.msg_type for r in lists for m in r.messages) == ["PktDownIo", "PktUpIoReserve", "PktUpIoReserve"]


def test_keyed_log_counts(spark):
    df = spark.range(20).select(F.timestamp_add("SECOND", F.col("id") * 10, F.expr("timestamp_ntz'2024-01-01'")).alias("ts"),
                                F.concat(F.lit("line "), "id").alias("line"))
    out = [json.loads(r.value) for r in keyed_log_counts(df, "line", "ts", 3).collect()]
    assert sum(o["n"] for o in out) == 20 and {o["group_id"] for o in out} <= {0, 1, 2}


def test_offsets(spark):
    df = spark.createDataFrame([("topic: t_1    partition: 23    offsets: 1449968 to 1449976",)], "l string")
    assert tuple(df.select(P.offset_range("l").alias("o")).first().o) == ("t_1", 23, 1449968, 1449976, 8)


def test_registered_functions(spark):
    R.register_sql_functions(spark)
    R.register_table_functions(spark)
    assert spark.sql("SELECT normalise_address(' a-b  c '), split_part_1('x,y', ',', 2)").first() == ("A B C", "y")
    got = spark.sql("SELECT t.k, s.* FROM VALUES ('a b c') AS t(k), LATERAL split_words(t.k, ' ') AS s").collect()
    assert [(r.pos, r.second_half, r.word) for r in got] == [(0, False, "a"), (1, False, "b"), (2, True, "c")]
    left = spark.sql("SELECT t.k, s.word FROM VALUES (''), ('q') AS t(k) LEFT JOIN LATERAL split_words(t.k, ' ') AS s ON TRUE").collect()
    assert sorted((r.k, r.word) for r in left) == [("", None), ("q", "q")]
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "k string, v double")
    spread = R.user_aggregate(lambda v: float(v.max() - v.min()))
    assert sorted(tuple(r) for r in df.groupBy("k").agg(spread("v")).collect()) == [("a", 2.0), ("b", 0.0)]
    top = R.user_table_aggregate(df, ["k"], lambda pdf: pdf.nlargest(1, "v"), "k string, v double")
    assert sorted(tuple(r) for r in top.collect()) == [("a", 3.0), ("b", 5.0)]
    other = spark.createDataFrame([("a",), ("c",)], "k string")
    sizes = R.user_cogroup(df, other, ["k"], lambda l, r: pd.DataFrame({"k": [(l if len(l) else r)["k"].iloc[0]], "n": [len(l) - len(r)]}),
                           "k string, n bigint")
    assert sorted(tuple(r) for r in sizes.collect()) == [("a", 1), ("b", 1), ("c", -1)]
    spark.conf.set("spark.tidepool.window", "7")
    assert one(spark, R.job_parameter(spark, "window", "1"), R.job_parameter(spark, "other", "d")) == ["7", "d"]
    names = {r.function for r in spark.sql("SHOW USER FUNCTIONS").collect()}
    assert any("normalise_address" in n for n in names)


def test_file_sources(spark, tmp_path):
    a, b = tmp_path / "a.txt", tmp_path / "b.txt"
    a.write_text("x\ny\n")
    b.write_text("z\n")
    assert sorted(r.value for r in files.text_lines(spark, str(a), str(b)).collect()) == ["x", "y", "z"]
    t = tmp_path / "c.tbl"
    t.write_text("1|Customer#1|addr|15|25-989|711.56|BUILDING|comment|\n")
    got = files.delimited(spark, str(t), "key bigint, name string, addr string, nation int, bal double", "|", "11110100")
    assert [tuple(r) for r in got.collect()] == [(1, "Customer#1", "addr", 15, 711.56)]
    assert "phone" not in str(got.columns)
    with pytest.raises(ValueError):
        files.delimited(spark, str(t), "key bigint", "|", "110")
    p = tmp_path / "pts"
    p.write_text("1.5 2.5\n")
    assert [tuple(r) for r in files.delimited(spark, str(p), "x double, y double", " ").collect()] == [(1.5, 2.5)]
    lake = str(tmp_path / "lake")
    spark.range(20).selectExpr("IF(id = 0, NULL, id) AS a", "id * 2 AS b").write.parquet(lake)
    scan = files.table_scan(spark, lake, ["b"], F.col("a").isNotNull() & (F.col("b") >= 12))
    assert sorted(r.b for r in scan.collect()) == list(range(12, 40, 2))
    plan = scan._jdf.queryExecution().toString()
    assert "IsNotNull(a)" in plan and "GreaterThanOrEqual(b,12)" in plan
    assert files.socket_options("h", 9) == {"host": "h", "port": "9"}


def test_generated(spark):
    spec = [generated.Field("t_id", "sequence", start=1), generated.Field("amount", dtype="double", low=91, high=109),
            generated.Field("branch", dtype="int", low=3001, high=3008), generated.Field("params", dtype="string", length=200)]
    rows = generated.generated(spark, 500, spec).collect()
    assert [r.t_id for r in rows] == list(range(1, 501))
    assert all(91 <= r.amount <= 109 and 3001 <= r.branch <= 3008 and len(r.params) == 200 for r in rows)
    assert {r.branch for r in rows} == set(range(3001, 3009))
    assert rows == generated.generated(spark, 500, spec).collect()
    assert generated.generated_stream(spark, 5, spec).isStreaming
    assert generated.numbers(spark, 3, 5).count() == 3
    assert generated.literal_rows(spark, "a int, b string", [(1, None)]).first() == (1, None)


def test_topics(spark):
    assert broker.topic_options("s:9092", "t", "timestamp", at_ms=5)["startingTimestamp"] == "5"
    assert broker.topic_options("s:9092", "t", "latest", max_offsets=9)["maxOffsetsPerTrigger"] == "9"
    assert broker.topic_options("s:9092", "t", "group", group="g")["kafka.group.id"] == "g"
    for bad in ({"start": "timestamp"}, {"start": "group"}, {"start": "soon"}):
        with pytest.raises(ValueError):
            broker.topic_options("s", "t", **bad)
    df = spark.createDataFrame([('{"a":1,"b":"x"}',), ('{"a":"no","b":"y"}',), ("broken",)], "value string")
    got = broker.decode_json(df, "a int, b string", ignore_errors=True)
    assert [tuple(r) for r in got.collect()] == [(1, "x"), (None, "y")]
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        broker.decode_json(df, "a int, b string").collect()
    part = spark.createDataFrame([('{"a":1}',)], "value string")
    assert broker.decode_json(part, "a int, b string").first() == (1, None)
    with pytest.raises(Exception, match="missing fields: b"):
        broker.decode_json(part, "a int, b string", fail_on_missing=True).collect()
    csv = spark.createDataFrame([("1|z",)], "value string")
    assert broker.decode_csv(csv, "a int, b string", "|").first() == (1, "z")
    changes = spark.createDataFrame([("+I", 1, "a", None), ("-U", 1, "a", None), ("+U", 1, "b", 2), ("-D", 2, "c", 3)],
                                    "op string, id int, name string, n int")
    got = [(r.key, r.value) for r in broker.upsert_records(changes, ["id"], "op").collect()]
    assert got == [('{"id":1}', '{"name":"a","n":null}'), ('{"id":1}', '{"name":"b","n":2}'), ('{"id":2}', None)]
    assert json.loads(broker.append_records(changes.select("id")).first().value) == {"id": 1}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "i int, s string")
    out = str(tmp_path / "csv")
    sinks.write_delimited(df.coalesce(1), out, "|")
    assert sorted(r.value for r in spark.read.text(out).collect()) == ["1|a", "2|b"]
    text = str(tmp_path / "text")
    sinks.write_text(df, text, single_file=True)
    assert len(list((tmp_path / "text").glob("part-*"))) == 1
    sinks.discard(df)
    made = []
    sinks.write_all(df, lambda d: made.append(d.count()), lambda d: made.append(d.agg(F.sum("i")).first()[0]))
    assert made == [2, 3]
    assert sorted(r.i for r in sinks.rows(df)) == [1, 2]
    settings = sinks.database_options("jdbc:x", "t", user="u", batch_rows=5)
    assert settings == {"url": "jdbc:x", "dbtable": "t", "batchsize": "5", "user": "u"}
    seen = []
    sinks.retract_sink(lambda d, i: seen.append((i, [r.is_add for r in d.collect()])))(
        spark.createDataFrame([("+I", 1), ("-D", 1)], "op string, v int"), 7)
    assert seen == [(7, [True, False])]
