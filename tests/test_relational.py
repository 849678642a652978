"""Relational operators against small golden tables."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidepool.functions.scalar import merge_rows
from tidepool.functions.text import contains_all, english_tweet_words, normalise_address, split_as_array, split_rows, tokens, whitespace_words
from tidepool.operators.aggregates import (
    bounded_lists, exact_percentiles, last_dated, latency_lines, signed_average, smallest_per_group,
)
from tidepool.operators.changelog import latest_per_key, sign
from tidepool.operators.expand import (
    blank_counts, canonical, column_range, hash_salt, nonblank_rows, template_rows, undirected, weighted_group,
)
from tidepool.operators.joins import (
    anti, asof_join, interval_join, join_huge, join_tiny, latest_then_left_joins, lookup_join, plan_bytes, semi_in, window_join,
)
from tidepool.operators.ranking import top_n, top_share
from tidepool.operators.scan import running_count, scan, seq_chunk

# Sample customers.
CUSTOMERS = [
    ("Guillermo Smith", dt.date(1992, 12, 12), "4081 Valley Road", "08540", "New Jersey", "m", True, 0, 78, 3),
    ("Valeria Mendoza", dt.date(1970, 3, 28), "1239  Rainbow Road", "90017", "Los Angeles", "f", True, 9, 39, 0),
    ("Leann Holloway", dt.date(1989, 5, 21), "2359 New Street", "97401", "Eugene", None, True, None, None, None),
    ("Brandy Sanders", dt.date(1956, 5, 26), "4891 Walkers-Ridge-Way", "73119", "Oklahoma City", "m", False, 9, 39, 0),
    ("John Turner", dt.date(1982, 10, 2), "2359 New Street", "60605", "Chicago", "m", True, 12, 39, 0),
    ("Ellen Ortega", dt.date(1985, 6, 18), "2448 Rodney STreet", "85023", "Phoenix", "f", True, 0, 78, 3),
]
CUSTOMER_SCHEMA = ("name string, date_of_birth date, street string, zip_code string, city string, gender string, "
                   "has_newsletter boolean, a int, b int, c int")

# Population changes.
POPULATION = [
    ("Los Angeles", "CA", 2013, 13106100), ("Los Angeles", "CA", 2014, 72600), ("Los Angeles", "CA", 2015, 72300),
    ("Chicago", "IL", 2013, 9553270), ("Chicago", "IL", 2014, 11340), ("Chicago", "IL", 2015, -6730),
    ("Houston", "TX", 2013, 6330660), ("Houston", "TX", 2014, 172960), ("Houston", "TX", 2015, 172940),
    ("Phoenix", "AZ", 2013, 4404680), ("Phoenix", "AZ", 2014, 86740), ("Phoenix", "AZ", 2015, 89700),
    ("San Antonio", "TX", 2013, 2280580), ("San Antonio", "TX", 2014, 49180), ("San Antonio", "TX", 2015, 50870),
    ("San Francisco", "CA", 2013, 4521310), ("San Francisco", "CA", 2014, 65940), ("San Francisco", "CA", 2015, 62290),
    ("Dallas", "TX", 2013, 6817520), ("Dallas", "TX", 2014, 137740), ("Dallas", "TX", 2015, 154020),
]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_customer_report(spark):
    customers = spark.createDataFrame(CUSTOMERS, CUSTOMER_SCHEMA)
    people = column_range(customers, 1, 7)
    assert people.columns[-1] == "has_newsletter"
    summary = people.agg(F.count("*"), F.floor(F.avg(F.year("date_of_birth")))).first()
    assert tuple(summary) == (6, 1979)
    wanted = people.where("gender IS NOT NULL AND has_newsletter AND date_of_birth >= date'1980-01-01'").select(
        F.upper("name"), "date_of_birth", normalise_address("street", "zip_code", "city"))
    assert rows(wanted) == [
        ("ELLEN ORTEGA", dt.date(1985, 6, 18), "2448 RODNEY STREET, 85023, PHOENIX"),
        ("GUILLERMO SMITH", dt.date(1992, 12, 12), "4081 VALLEY ROAD, 08540, NEW JERSEY"),
        ("JOHN TURNER", dt.date(1982, 10, 2), "2359 NEW STREET, 60605, CHICAGO"),
    ]


def test_top_cities_per_state(spark):
    updates = spark.createDataFrame(POPULATION, "city string, state string, update_year int, population_diff int")
    totals = updates.groupBy("city", "state").agg(
        F.max("update_year").alias("latest_year"), F.sum("population_diff").alias("population"))
    best = top_n(totals, ["state"], [F.desc("population"), F.desc("latest_year")], 2)
    want = [("Chicago", 9557880), ("Dallas", 7109280), ("Houston", 6676560), ("Los Angeles", 13251000),
            ("Phoenix", 4581120), ("San Francisco", 4649540)]
    assert rows(best.select("city", "population")) == want
    totals.createOrReplaceTempView("totals")
    lateral = spark.sql("""SELECT t.city, t.population FROM (SELECT DISTINCT state FROM totals) s,
        LATERAL (SELECT city, population FROM totals WHERE state = s.state ORDER BY population DESC, latest_year DESC LIMIT 2) t""")
    assert rows(lateral) == want


def test_union_of_filtered_orders(spark):
    schema = "user bigint, product string, amount int"
    a = spark.createDataFrame([(1, "beer", 3), (1, "diaper", 4), (3, "rubber", 2)], schema)
    b = spark.createDataFrame([(2, "pen", 3), (2, "rubber", 3), (4, "beer", 1)], schema)
    assert rows(a.where("amount > 2").unionByName(b.where("amount < 2"))) == [(1, "beer", 3), (1, "diaper", 4), (4, "beer", 1)]
    assert [r[1] for r in rows(a.unionByName(b).where("amount > 2"))] == ["beer", "diaper", "pen", "rubber"]


def test_word_counts_and_running_counts(spark):
    words = spark.createDataFrame([("Hello", 1), ("Ciao", 1), ("Hello", 1)], "word string, frequency bigint")
    counts = words.groupBy("word").agg(F.sum("frequency").alias("frequency"))
    assert rows(counts) == [("Ciao", 1), ("Hello", 2)]
    assert rows(counts.where("frequency = 2")) == [("Hello", 2)]
    tweet = '{"id":%d,"text":"Apache  Spark","user":{"lang":"%s","name":"x"}}'
    lines = spark.createDataFrame([(tweet % (i, lang), i) for i, lang in enumerate(["en", "en", "de", "en"])]
                                  + [('{"id":9}', 9)], "value string, seq int")
    each = lines.select("seq", F.explode(english_tweet_words("value")).alias("word"))
    running = scan(each, ["word"], ["seq"], seq_chunk("seq", 2), {"n": running_count()}, heavy_rows=0).select("word", "n")
    assert rows(running) == [("apache", 1), ("apache", 2), ("apache", 3), ("spark", 1), ("spark", 2), ("spark", 3)]


def test_names_allow_list_batch_and_upper(spark):
    names = spark.createDataFrame([("Bob",), ("Alice",), ("Greg",), ("Bob",)], "name string")
    allowed = spark.createDataFrame([("Bob",), ("Alice",)], "allowed string")
    assert rows(semi_in(names, allowed, "name", "allowed").distinct().withColumn("n", F.lit(1))) == [("Alice", 1), ("Bob", 1)]
    many = spark.createDataFrame([(n,) for n in ["Alice", "alice", "lily", "Bob", "lily", "lily"]], "name string")
    assert rows(many.groupBy(F.upper("name")).count()) == [("ALICE", 2), ("BOB", 1), ("LILY", 3)]


def test_joins_by_name_and_hints(spark):
    users = spark.createDataFrame([(1, "Peter"), (2, "John"), (3, "Bill")], "userIdentifier int, name string")
    mails = spark.createDataFrame([(1, "s1", "b1"), (1, "s2", "b2"), (3, "s3", "b3")], "userId int, subject string, body string")
    on = users.userIdentifier == mails.userId
    want = [("Bill", "s3"), ("Peter", "s1"), ("Peter", "s2")]
    for joined in (users.join(mails, on), join_tiny(users, mails, on), join_huge(users, mails, on)):
        assert rows(joined.select("name", "subject")) == want
    assert plan_bytes(users) > 0
    assert rows(anti(users, mails.select(F.col("userId").alias("userIdentifier")), ["userIdentifier"])) == [(2, "John")]


def test_web_log(spark):
    docs = spark.createDataFrame([("u1", " a editors b oscillations c "), ("u2", " editors "), ("u3", " editors oscillations ")],
                                 "url string, text string")
    ranks = spark.createDataFrame([(41, "u1", 5), (99, "u2", 5), (50, "u3", 1)], "rank int, url string, avg_duration int")
    visits = spark.createDataFrame([("u3", "2007-1-5"), ("u1", "2006-12-1")], "url string, date string")
    keep = docs.where(contains_all("text", [" editors ", " oscillations "])).select("url")
    ranked = ranks.where("rank > 40").join(keep, "url").select("rank", "url", "avg_duration")
    seen = visits.where(F.substring("date", 1, 4).cast("int") == 2007)
    assert rows(anti(ranked, seen, ["url"]).select("rank", "url", "avg_duration")) == [(41, "u1", 5)]


def test_blank_fields(spark):
    people = spark.createDataFrame(
        [("John", "Doe", "Foo Str."), ("Joe", "Johnson", ""), (None, "Kate Morn", "Bar Blvd."), ("Tim", "Rinny", ""),
         ("Alicia", "Jackson", "  ")], "a string, b string, c string")
    assert tuple(blank_counts(people, ["a", "b", "c"]).first()) == (5, 1, 0, 3)
    kept, seen = nonblank_rows(people, ["a", "b", "c"])
    assert rows(kept) == [("John", "Doe", "Foo Str.")]
    assert seen.get == {"a": 1, "b": 0, "c": 3}


def test_tokens_and_splits(spark):
    one = spark.createDataFrame([("To be, or not -- to be!", "a  b ", "x||y||", None)], "t string, w string, p string, n string")
    out = one.select(tokens("t"), whitespace_words("w"), split_as_array("p", r"\|\|"), split_as_array("n", ","),
                     split_as_array(F.lit(""), ",")).first()
    assert list(out) == [["to", "be", "or", "not", "to", "be"], ["a", "", "b"], ["x", "y"], None, None]
    parts = split_rows(spark.createDataFrame([("red blue green",)], "s string"), "s", " ")
    assert rows(parts.select("pos", "second_half", "word", "word_length")) == [
        (0, False, "red", 3), (1, False, "blue", 4), (2, True, "green", 5)]
    empty = spark.createDataFrame([("k", None)], "k string, s string")
    assert rows(split_rows(empty, "s", " ", outer=True).select("k", "word")) == [("k", None)]


def test_last_dated_and_merge(spark):
    d = dt.date
    data = [("Guillermo", d(2020, 12, 1), 3), ("Guillermo", d(2020, 12, 5), 5), ("Valeria", d(2020, 3, 23), 4),
            ("Valeria", d(2020, 6, 2), 10), ("Leann", d(2020, 5, 26), 9), ("Leann", d(2020, 5, 27), None)]
    df = spark.createDataFrame(data, "name string, order_date date, item_count int")
    out = df.groupBy("name").agg(last_dated("item_count", "order_date").alias("l")).select("name", "l.*")
    assert rows(out) == [("Guillermo", 5, d(2020, 12, 5)), ("Leann", 9, d(2020, 5, 26)), ("Valeria", 10, d(2020, 6, 2))]
    nested = spark.createDataFrame([("G", (d(1992, 12, 12),), ("New Jersey", "816"))],
                                   "name string, data1 struct<birth_date:date>, data2 struct<city:string,phone:string>")
    merged = merge_rows(nested, "data1", "data2", "m")
    assert merged.schema["m"].dataType.simpleString() == "struct<f0:date,f1:string,f2:string>"
    assert tuple(merged.first()["m"]) == (d(1992, 12, 12), "New Jersey", "816")


def test_percentiles(spark):
    data = [("x", v) for v in (1.12, None, 33.14, 44.31234, 55.002)] + [("none", None)]
    df = spark.createDataFrame(data, "city string, num double")
    out = {r.city: r.percentiles for r in exact_percentiles(df, ["city"], "num", [50, 75, 90, 95, 99]).collect()}
    assert out == {"x": [38.726, 46.985, 51.795, 53.399, 54.681], "none": None}


@pytest.mark.parametrize("accuracy", [20, 10_000])
def test_percentiles_of_odd_numbers(spark, accuracy):
    """Infinite values, NaN and very large numbers, in groups above and below the sketch's size."""
    inf, nan = float("inf"), float("nan")
    groups = {
        "nan": [float(i) for i in range(300)] + [nan] * 40, "inf": [-inf] * 30 + [float(i % 7) for i in range(200)] + [inf] * 50,
        "large": [i * 1e22 for i in range(150)], "only": [nan], "mixed": [inf, nan, -inf], "wide": [-1.5e308, 1.5e308, 0.0] * 40}
    rows = spark.createDataFrame([(k, v) for k, values in groups.items() for v in values], "k string, v double")
    percents = [0, 25, 50, 90, 99, 100]
    for r in exact_percentiles(rows, ["k"], "v", percents, accuracy=accuracy, heavy_rows=30).collect():
        values = sorted(groups[r.k], key=lambda v: (v != v, v))
        for p, got in zip(percents, r.percentiles, strict=True):
            low, rest = divmod(p * (len(values) - 1), 100)
            a, b = values[low], values[min(low + 1, len(values) - 1)]
            want = a if not rest or a == b or (a != a and b != b) else a + (b - a) * (rest / 100)
            assert (got != got and want != want) or got == want or abs(got - want) <= max(6e-4, abs(want) * 1e-12), (r.k, p, got, want)


def test_percentile_brackets_match_builtin(spark):
    """A low sketch accuracy forces bracketing, chunked ranks and the counted rows below the bracket."""
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 2)).alias("k"),
        F.round(F.pow(F.rand(7), 6) * 1000, 2).alias("v")).cache()
    percents = [1, 50, 95, 99.9]
    got = exact_percentiles(df, ["k"], "v", percents, accuracy=100, heavy_rows=50)
    want = df.groupBy("k").agg(F.percentile("v", F.lit([p / 100 for p in percents])).alias("w"))
    for r in got.join(want, "k").collect():
        assert [abs(a - b) < 6e-4 for a, b in zip(r.percentiles, r.w, strict=True)] == [True] * 4, r


def test_latency_lines(spark):
    df = spark.createDataFrame([(i,) for i in [0, 1, 2, 3, 4, 5, 100, 70000]] + [(i,) for i in range(1, 93)], "x bigint")
    counts = {}
    for x in [0, 1, 2, 3, 4, 5, 100, 70000, *range(1, 93)]:
        b = 0 if x <= 1 else min(16, (x - 1).bit_length())
        counts[b] = counts.get(b, 0) + 1
    total, want = 100, []
    for share in (0.5, 0.25, 0.1, 0.05, 0.01, 0.001, 0.0001):
        need, read = max(1, int(total * share)), 0
        for b in sorted(counts, reverse=True):
            read += counts[b]
            if read >= need:
                want.append(str(2 ** b))
                break
    assert latency_lines(df, [], "x").first()["lines"] == ":".join(want)


def test_bounded_lists_keep_everything(spark):
    df = spark.range(1000).withColumn("k", F.when(F.col("id") < 700, "hot").otherwise("cold"))
    out = bounded_lists(df, ["k"], F.col("id"), "id", 100).collect()
    assert sorted(i for r in out for i in r["items"]) == list(range(1000))
    assert max(len(r["items"]) for r in out) <= 100


def test_table_aggregate_and_offsets(spark):
    df = spark.createDataFrame([("a", 30, 1), ("a", 10, 2), ("a", 20, 3), ("b", 5, 4)], "city string, age int, id int")
    assert rows(top_share(df, ["city"], "age", ["id"], 2).select("city", "rank", "age", "percent")) == [
        ("a", 1, 30, 0.6), ("a", 2, 20, 0.4), ("b", 1, 5, 1.0)]
    ranges = spark.createDataFrame([("t", 1, 5), ("t", 2, 5), ("t", 3, 9), ("t", 4, 2)], "topic string, part int, delta bigint")
    got = rows(smallest_per_group(ranges, ["topic"], "delta", ["part"]).select("part", "rank", "n", "min_delta", "max_delta", "avg_delta"))
    assert got == [(1, 2, 4, 2, 9, 5), (2, 3, 4, 2, 9, 5), (4, 1, 4, 2, 9, 5)]


def test_signed_average(spark):
    df = spark.createDataFrame([("+I", 10), ("+I", 20), ("-D", 10), ("+I", None)], "op string, v int")
    assert df.agg(signed_average("v", sign()).alias("a")).first()["a"] == 20.0


def test_three_way_left_join_on_upserts(spark):
    t1 = spark.createDataFrame([(1, "1"), (2, "2")], "pk int, x string")
    t2 = spark.createDataFrame([(1, "A", 1.0, "+I", 1), (2, "B", 2.0, "+I", 2), (1, "A", 1.1, "+U", 3), (2, "B", 2.1, "+U", 4)],
                               "pk2_ int, y string, some_value double, op string, seq int")
    t3 = spark.createDataFrame([("1", "A", 10.0), ("1", "B", 11.0)], "pk1 string, pk2 string, other double")
    latest = latest_per_key(t2, ["pk2_"], ["seq"]).select("pk2_", "y", "some_value")
    keyed = t3.select(F.col("pk1").alias("j1"), F.col("pk2").alias("j2"), "pk1", "pk2", "other")
    out = latest_then_left_joins(t1, (latest, [("pk", "pk2_")]), (keyed, [("x", "j1"), ("y", "j2")]))
    got = rows(out.select("pk", F.round(F.col("some_value") * F.col("other"), 6), "pk1", "pk2"))
    assert got == [(1, 11.0, "1", "A"), (2, None, None, None)]


def test_interval_join_matches_plain_join(spark):
    l = spark.range(300).select((F.col("id") % 3).alias("k"), F.col("id").alias("lid"),
                                F.timestamp_add("SECOND", (F.col("id") * 37) % 1000, F.expr("timestamp_ntz'2024-01-01'")).alias("lt"))
    r = spark.range(300).select((F.col("id") % 3).alias("k"), F.col("id").alias("rid"),
                                F.timestamp_add("SECOND", (F.col("id") * 53) % 1000, F.expr("timestamp_ntz'2024-01-01'")).alias("rt"))
    for how in ("inner", "left"):
        got = interval_join(l, r, ["k"], "lt", "rt", -40_000_000, 20_000_000, how).select("k", "lid", "rid")
        rr = r.withColumnRenamed("k", "k2")
        want = l.join(rr, F.expr("k = k2 AND rt BETWEEN lt - INTERVAL 40 SECONDS AND lt + INTERVAL 20 SECONDS"), how).select("k", "lid", "rid")
        assert rows(got) == rows(want)


def test_asof_join_picks_latest_version(spark):
    ts = lambda s: dt.datetime(2024, 1, 1, 0, 0, s)
    orders = spark.createDataFrame([(1, "e", ts(5)), (2, "e", ts(1)), (3, "u", ts(9)), (4, None, ts(9))],
                                   "id int, cur string, t timestamp_ntz")
    rates = spark.createDataFrame([("e", 1.0, ts(2)), ("e", 2.0, ts(5)), ("e", 3.0, ts(6))], "cur string, rate double, vt timestamp_ntz")
    for heavy in (0, 1000):
        out = asof_join(orders, rates, ["cur"], "t", "vt", chunk_us=1_000_000, heavy_rows=heavy)
        assert rows(out.select("id", "rate")) == [(1, 2.0), (2, None), (3, None), (4, None)]


def test_window_and_lookup_join(spark):
    ts = lambda m: dt.datetime(2024, 1, 1, 0, m)
    g = spark.createDataFrame([("tom", 1, ts(0)), ("tom", 2, ts(1)), ("jerry", 3, ts(7))], "name string, grade int, gt timestamp_ntz")
    s = spark.createDataFrame([("tom", 100, ts(3)), ("tom", 200, ts(6)), ("jerry", 300, ts(9))], "name string, salary int, st timestamp_ntz")
    out = window_join(g, s, ["name"], "gt", "st", "5 minutes").select("name", "grade", "salary")
    assert rows(out) == [("jerry", 3, 300), ("tom", 1, 100), ("tom", 2, 100)]
    assert rows(lookup_join(g.select("name"), s.where("salary > 200").select("name", "salary"), ["name"])) == [
        ("jerry", 300), ("tom", None), ("tom", None)]


def test_edges_salts_templates(spark):
    e = spark.createDataFrame([(2, 1), (1, 2), (3, 3), (2, 5)], "src int, dst int")
    assert rows(canonical(e)) == [(1, 2), (2, 5)]
    assert undirected(e).count() == 8
    salted = spark.range(1000).select(hash_salt(["id"], 4).alias("s"), weighted_group(["id"], {"a": 3, "b": 1}).alias("g"))
    assert {r.s for r in salted.select("s").distinct().collect()} == {0, 1, 2, 3}
    shares = {r.g: r["count"] for r in salted.groupBy("g").count().collect()}
    assert shares["a"] > 2 * shares["b"] and sum(shares.values()) == 1000
    t = template_rows(spark.range(200), "id", {"color": ["red", "blue"], "size": [1, 2, 3]})
    assert {r.color for r in t.collect()} == {"red", "blue"} and {r["size"] for r in t.collect()} == {1, 2, 3}
