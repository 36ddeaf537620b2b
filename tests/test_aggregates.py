import math
import re
import statistics

import pytest
from pyspark.sql import functions as F

from millrace.operators import aggregates as agg
from millrace.operators import text as txt
from millrace.operators.ranking import numbered, top_k
from millrace.plans import QUERIES
from tests.plan_text import count, planned


@pytest.fixture(scope="module")
def skewed(spark):
    """Key 0 holds most rows, key NULL some, key 3 only NULL values; one value repeats a lot."""
    rows = spark.range(5000).select(
        F.col("id"),
        F.when(F.col("id") % 50 == 0, None).when(F.col("id") % 10 == 1, 1).when(F.col("id") % 40 == 2, 3).otherwise(0).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(7.5)).otherwise((F.col("id") * 37 % 1009) / 4).alias("v"),
    )
    return rows.withColumn("v", F.when(F.coalesce("k", F.lit(0)) != 3, F.col("v")))


def test_summary_keeps_null_groups(skewed):
    rows = {r.k: r for r in agg.summary_by(skewed, "k", "v").collect()}
    assert set(rows) == {None, 0, 1, 3}
    assert rows[3].avg_value is None and rows[3].n > 0
    assert [r.k for r in agg.summary_by(skewed, "k", "v").collect()][0] == 0


def test_five_numbers_are_exact(spark, skewed, conf):
    values = {}
    for r in skewed.collect():
        if r.v is not None:
            values.setdefault(r.k, []).append(r.v)
    for partitions in ("1", "8"):
        conf(shuffle__partitions=partitions)
        got = {r.k: r for r in agg.five_number(skewed, "k", "v").collect()}
        assert set(got) == set(values)
        for k, vs in values.items():
            vs = sorted(vs)
            quarters = statistics.quantiles(vs, n=4, method="inclusive")
            for have, want in zip(got[k][1:], [vs[0], *quarters, vs[-1]]):
                assert math.isclose(have, want), (k, have, want)


def test_one_value_five_numbers(spark):
    one = spark.createDataFrame([("a", 4.0)], "k STRING, v DOUBLE")
    assert tuple(agg.five_number(one, "k", "v").first()) == ("a", 4.0, 4.0, 4.0, 4.0, 4.0)


def test_two_stage_equals_plain(skewed):
    rows = skewed.withColumn("who", F.when(F.col("id") % 6 != 0, F.col("id") % 700))
    groups = {}
    for r in rows.collect():
        groups.setdefault(r.k, []).append(r)
    got = {r.k: r for r in agg.two_stage(rows, "k", "v", "who", "v").collect()}
    assert set(got) == set(groups)
    for k, members in groups.items():
        values = [r.v for r in members if r.v is not None]
        assert got[k].n == len(members) and got[k].distinct_values == len({r.who for r in members} - {None})
        if values:
            assert math.isclose(got[k].avg_value, statistics.fmean(values)) and math.isclose(got[k].median_value, statistics.median(values))
        else:
            assert got[k].avg_value is None and got[k].median_value is None


def test_no_task_holds_a_hot_keys_values(spark, conf):
    """The first shuffle spreads the NULL key by the counted value; the second one gets a row for each task and key."""
    conf(adaptive__enabled="false", shuffle__partitions="8")
    rows = spark.range(20_000).select(F.when(F.col("id") % 50 == 0, 1).alias("k"), (F.col("id") % 5000).alias("who"), F.col("id").cast("double").alias("v"))
    report = agg.two_stage(rows, "k", "v", "who", "v").select("k", "n", "avg_value", "distinct_values")
    assert {(r.k, r.distinct_values) for r in report.collect()} == {(None, 4900), (1, 100)}
    shares = rows.groupBy("k", "who").agg(F.count("*").alias("n")).where("k IS NULL").groupBy(F.spark_partition_id()).count().collect()
    assert len(shares) == 8 and max(r["count"] for r in shares) < 4900 / 4
    assert "hashpartitioning(k" in planned(report) and re.search(r"hashpartitioning\(k#\d+, who#\d+", planned(report))


def test_day_sketches_unite(spark, tmp_path):
    rows = spark.range(60_000).select((F.col("id") % 30).alias("day"), F.pmod(F.xxhash64("id"), F.lit(20_000)).alias("who"), F.lit("x").alias("kind"))
    agg.day_sketches(rows, "day", ["who", "kind"]).write.parquet(str(tmp_path / "s"))
    sketches = spark.read.parquet(str(tmp_path / "s"))
    exact = rows.select("who").distinct().count()
    month = agg.united_counts(sketches, ["who", "kind"]).first()
    assert month.n_rows == 60_000 and month.distinct_kind == 1
    assert abs(month.distinct_who - exact) <= 3 * 1.04 / 2**6 * exact  # lg 12: 4096 registers
    halves = agg.united_counts(sketches, ["who"], [(F.col("day") < 15).alias("early")]).collect()
    for r in halves:
        want = rows.where((F.col("day") < 15) == r.early).select("who").distinct().count()
        assert abs(r.distinct_who - want) <= 3 * 1.04 / 2**6 * want
    assert "count(distinct" not in planned(agg.united_counts(sketches, ["who"])).lower()
    few = agg.united_counts(agg.day_sketches(rows.where("who < 150"), "day", ["who"]), ["who"]).first()
    assert few.distinct_who == rows.where("who < 150").select("who").distinct().count()


def test_day_values_unite_exactly(spark, tmp_path):
    who = F.when(F.col("id") % 11 != 0, F.pmod(F.xxhash64("id"), F.lit(20_000)))
    rows = spark.range(60_000).select((F.col("id") % 30).alias("day"), who.alias("who"), F.lit("x").alias("kind"))
    agg.day_values(rows, "day", ["who", "kind"]).write.parquet(str(tmp_path / "v"))
    values = spark.read.parquet(str(tmp_path / "v"))
    want = rows.agg(F.count("*"), F.count_distinct("who"), F.lit(1)).first()
    assert tuple(agg.united_values(values, ["who", "kind"]).first()) == tuple(want)
    early = (F.col("day") < 15).alias("early")
    halves = agg.united_values(values, ["who", "kind"], [early])
    assert halves.columns == ["early", "n_rows", "distinct_who", "distinct_kind"]
    exact = rows.groupBy(early).agg(F.count("*"), F.count_distinct("who"), F.count_distinct("kind"))
    assert sorted(map(tuple, halves.collect())) == sorted(map(tuple, exact.collect()))


def test_distinct_query_is_exact_with_many_users(spark, tmp_path):
    """Far more users than a sketch counts exactly."""
    ts = F.expr("timestampadd(MINUTE, id % 40000, TIMESTAMP_NTZ '2024-01-01 00:00:00')")
    events = spark.range(30_000).select(F.col("id").alias("event_id"), ts.alias("ts"), F.pmod(F.xxhash64("id"), F.lit(7_000)).alias("user_id"), F.concat(F.lit("t"), F.col("id") % 5).alias("event_type"))
    events.write.parquet(str(tmp_path / "events.parquet"))
    got = QUERIES["agg_distinct_approx"](spark, str(tmp_path)).select("month", "n_rows", "distinct_user_id", "distinct_event_type").collect()
    want = events.groupBy(F.month("ts")).agg(F.count("*"), F.count_distinct("user_id"), F.count_distinct("event_type")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_four_ways_share_a_plan(spark, data):
    li = spark.read.parquet(f"{data}/lineitem.parquet")
    args = ("l_returnflag", "l_quantity", "l_extendedprice", 40.0)
    sql, chain = planned(agg.fast_sql(li, *args)), planned(agg.fast_df(li, *args))
    plain = [re.sub(r"#\d+L?|plan_id=\d+", "", p) for p in (sql, chain)]
    assert plain[0] == plain[1]
    assert "GreaterThanOrEqual(l_quantity,40.0)" in sql
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double,l_returnflag:string>" in sql
    udf = planned(agg.fast_udf(li, *args))
    assert "PushedFilters: []" in udf and "ArrowEvalPython" in udf


def test_ratio_warns_below_three(spark):
    a, b = spark.range(10), spark.range(4)
    assert tuple(agg.table_ratio(a, b).first()) == (10, 4, 2.5, True)
    assert tuple(agg.table_ratio(a, spark.range(0)).first())[2:] == (10.0, False)


def test_approx_distinct(spark):
    df = spark.range(20_000).select((F.col("id") % 3000).alias("k"))
    exact = agg.cardinality(df, ["k"]).first()
    approx = agg.cardinality(df, ["k"], approx=True).first()
    assert tuple(exact) == (20_000, 3000)
    assert abs(approx.distinct_k - 3000) < 300


def test_replicate(spark):
    plan = agg.replicate(spark.range(5), 80)
    assert plan.count() == 400
    assert "Cartesian" not in planned(plan) and "NestedLoop" not in planned(plan)


@pytest.mark.parametrize("partitions", ["1", "8"])
def test_numbered(spark, skewed, conf, partitions):
    conf(shuffle__partitions=partitions)
    rows = numbered(skewed.select("id", "k"), [F.desc("id")], within=["k"]).collect()
    assert len(rows) == 5000
    by_key = {}
    for r in rows:
        by_key.setdefault(r.k, []).append((r.pos, -r.id))
    for k, places in by_key.items():
        places.sort()
        assert [p for p, _ in places] == list(range(len(places)))
        assert [i for _, i in places] == sorted(i for _, i in places)
    overall = numbered(skewed.select("id"), [F.col("id")]).collect()
    assert all(r.id == r.pos for r in overall)


def test_empty_inputs(spark):
    none = spark.createDataFrame([], "k STRING, v DOUBLE")
    assert numbered(none, [F.col("v")], within=["k"]).collect() == []
    assert agg.five_number(none, "k", "v").collect() == []


def test_top_k_needs_no_full_sort(spark):
    top = top_k(spark.range(100), 3, [F.desc("id")])
    assert [(r.id, r.pos) for r in top.orderBy("pos").collect()] == [(99, 1), (98, 2), (97, 3)]
    assert "TakeOrderedAndProject" in planned(top)


TEXTS = ["Hello, hello!  (World)\tdon't stop.", "... --- ;:", "\n\"Quoted\" end's x.y", "", "ÀÉ é"]


def python_tokens(line):
    return [t for t in (w.strip(".,;:!?\"'()") for w in line.lower().split()) if t]


def test_tokens_follow_the_rule(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id INT, text STRING")
    want = {}
    for line in TEXTS:
        for t in python_tokens(line):
            want[t] = want.get(t, 0) + 1
    assert {r.word: r.n for r in txt.word_count(df, "text").collect()} == want
    assert {r.word: r.n for r in txt.word_count_grouped(df, "text", ["id"]).collect()} == want
    routes = {r.route: r.n_words for r in txt.distinct_words(df, "text", ["id"]).collect()}
    assert routes == {"combine": len(want), "grouped": len(want)}


def test_combine_and_grouped_plans(spark):
    df = spark.createDataFrame([(1, "a b")], "id INT, text STRING")
    assert count(planned(txt.word_count(df, "text")), "Exchange") == 1
    grouped = planned(txt.word_count_grouped(df, "text", ["id"]))
    assert "REPARTITION_BY_COL" in grouped


def test_replicated_corpus_moves_texts_once(spark, data, monkeypatch):
    writer = type(spark.range(1).write)
    real, plans = writer.text, []

    def text(self, *args, **options):
        plans.append(planned(self._df))
        real(self, *args, **options)

    monkeypatch.setattr(writer, "text", text)
    QUERIES["corpus_replicated"](spark, data)
    assert len(plans) == 1 and plans[0].count("Exchange ") == 1
