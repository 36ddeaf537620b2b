from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.operators import joins, skew
from millrace.operators.joins import by_flag
from millrace.plans import QUERIES
from millrace.session import stored
from millrace.sources.layout import write_files
from tests.plan_text import count, executed, planned, shuffle_records

FACT = [(i, None if i % 4 else f"k{i % 3}", i / 2) for i in range(200)] + [(900, "lost", 1.0), (901, None, None)]


@pytest.fixture(scope="module")
def fact(spark):
    return spark.createDataFrame(FACT, "id INT, k STRING, v DOUBLE")


@pytest.fixture(scope="module", params=["plain", "null_key"])
def dim(spark, request):
    rows = [("k0", True), ("k1", False), ("k2", True)] + ([(None, True)] if request.param == "null_key" else [])
    return spark.createDataFrame(rows, "code STRING, is_out BOOLEAN")


@pytest.fixture(scope="module")
def big(spark, data):
    li, o = spark.read.parquet(f"{data}/lineitem.parquet"), spark.read.parquet(f"{data}/orders.parquet")
    return li, o, li.l_orderkey == o.o_orderkey


def test_all_left_joins_agree(spark, fact, dim):
    plain = joins.join_outcome(fact, dim, "k", "code").select("id", "is_out")
    others = [
        joins.join_outcome_apart(fact, dim, "k", "code"),
        joins.join_outcome(fact, joins.checked_broadcast(dim), "k", "code"),
        skew.skew_join(fact, dim, "k", "code"),
        *[skew.salted_join(fact, dim, "k", "code", ["id"], n) for n in (None, 1, 4, 16, 64)],
    ]
    assert plain.count() == len(FACT)
    for other in others:
        assert joins.difference(plain, other.select("id", "is_out")).count() == 0
    lost = joins.unmatched(fact, dim, fact.k == dim.code)
    assert lost.where("k IS NOT NULL").count() == 1


def test_difference_counts_copies(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "n INT")
    b = spark.createDataFrame([(1,), (3,)], "n INT")
    assert {tuple(r) for r in joins.difference(a, b).collect()} == {(1, "left"), (2, "left"), (3, "right")}


def test_broadcast_only_if_it_fits(spark, conf, fact, dim):
    conf(autoBroadcastJoinThreshold="-1")
    on = fact.k == dim.code
    assert count(planned(fact.join(joins.checked_broadcast(dim), on)), "BroadcastHashJoin") == 1
    for limit in ({"max_rows": 2}, {"max_bytes": 10}):
        assert "Broadcast" not in planned(fact.join(joins.checked_broadcast(dim, **limit), on))


def test_merge_and_shuffle_hash_plans(conf, big):
    conf(adaptive__enabled="false", autoBroadcastJoinThreshold="-1")
    merge = planned(joins.join_facts(*big, strategy="merge"))
    assert (count(merge, "SortMergeJoin"), count(merge, "Exchange"), count(merge, "Sort ")) == (1, 2, 2)
    hashed = planned(joins.join_facts(*big, strategy="shuffle_hash"))
    assert (count(hashed, "ShuffledHashJoin"), count(hashed, "Exchange"), count(hashed, "Sort ")) == (1, 2, 0)
    assert "BuildRight" in hashed


def test_rare_join_becomes_a_broadcast(conf, big):
    conf(adaptive__enabled="true", autoBroadcastJoinThreshold="20KB")
    li, o, on = big
    rare = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_custkey") % 50 == 0)
    j = joins.join_rare(li, o, on, rare)
    assert count(planned(j), "SortMergeJoin") == 1
    assert count(executed(j), "BroadcastHashJoin") == 1


def test_inner_join_filters_null_keys_on_both_sides(spark, conf, tmp_path, fact, dim):
    conf(adaptive__enabled="false", autoBroadcastJoinThreshold="-1")
    fact.write.parquet(str(tmp_path / "f"))
    dim.write.parquet(str(tmp_path / "d"))
    f, d = spark.read.parquet(str(tmp_path / "f")), spark.read.parquet(str(tmp_path / "d"))
    assert planned(joins.join_outcome(f, d, "k", "code", "inner")).count("PushedFilters: [IsNotNull") == 2
    assert planned(joins.join_outcome(f, d, "k", "code", "left")).count("PushedFilters: [IsNotNull") == 1


def test_hash_partition_is_sparks(spark, fact):
    moved = fact.repartition(8, "k").groupBy(F.spark_partition_id().alias("pid")).count()
    want = {r.pid: r["count"] for r in moved.collect()}
    sizes = {r.pid: r.n for r in skew.partition_sizes(fact, "k", 8).collect()}
    assert set(sizes) == set(range(8))
    assert {p: n for p, n in sizes.items() if n} == want
    profile = skew.partition_profile(fact, "k", 8).first()
    assert (profile.partitions_nonempty, profile.max_rows, profile.min_rows) == (len(want), max(want.values()), min(want.values()))


def test_key_profile(fact):
    p = skew.key_profile(fact, "k").first()
    assert (p.distinct_keys, p.hottest_key, p.hottest_rows) == (5, None, 151)
    assert p.median_rows == 17.0 and p.skew_ratio == round(151 / 17, 2)


def test_hottest_tie_goes_to_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), ("c",)], "k STRING")
    assert skew.key_profile(df, "k").first().hottest_key == "a"


def test_profile_keys_marks_the_widest(fact):
    rows = {r.key: r for r in skew.profile_keys(fact, ["id", "k"], 8).collect()}
    gaps = {k: abs(r.skew_ratio - r.partition_skew_ratio) for k, r in rows.items()}
    assert [k for k, r in rows.items() if r.widest] == [max(gaps, key=gaps.get)]


def test_salt_is_stable_and_spreads_nulls(fact):
    salted = skew.with_salt(fact, ["id"], 16)
    again = skew.with_salt(fact.repartition(5), ["id"], 16)
    assert joins.difference(salted, again).count() == 0
    assert salted.where("k IS NULL").select("_salt").distinct().count() > 8
    assert salted.where("_salt < 0 OR _salt > 15 OR _salt IS NULL").count() == 0


def test_adaptive_skew_split(spark, tmp_path):
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 4 == 0, F.concat(F.lit("k"), F.col("id") % 5)).alias("k"), F.rand(1).alias("v"), "id"
    )
    write_files(rows, str(tmp_path / "f"), 8)
    write_files(spark.range(5).select(F.concat(F.lit("k"), "id").alias("code"), (F.col("id") > 2).alias("is_out")), str(tmp_path / "d"), 1)
    session = skew.skew_session(spark, partition_bytes=10_000, factor=1.5, advisory=10_000)
    session.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))
    j = skew.skew_join(session.read.parquet(str(tmp_path / "f")), session.read.parquet(str(tmp_path / "d")), "k", "code")
    report = by_flag(j, "is_out", "v")
    assert "skew=true" in executed(report)
    assert {(r.is_out, r.n) for r in report.collect()} == {(None, 30_000), (False, 6000), (True, 4000)}


def test_sweep_counts_the_partitions_it_used(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("k"), F.col("id").cast("double").alias("v"))
    rows = skew.partition_sweep(df, "k", "v", [1, 4, 300]).collect()
    assert {(r.partitions, r.used) for r in rows if r.partitions < 300} == {(1, 1), (4, 4)}
    assert {r.used for r in rows if r.partitions == 300} <= set(range(2, 101))
    assert {(r.k, r.n, r.avg_value) for r in rows} == {(0, 50, 49.0), (1, 50, 50.0)}


def test_salting_copies_hot_dimension_rows_only(spark):
    fact = spark.range(1000).select(F.col("id"), F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 97).cast("int").alias("k"), F.lit(1.0).alias("v"))
    dim = spark.range(200).select(F.col("id").cast("int").alias("code"), F.lit(True).alias("is_out"))
    joined = skew.salted_join(fact, dim, "k", "code", ["id"], n=8)
    plain = joins.join_outcome(fact, dim, "k", "code")
    assert joins.difference(joined.select("id", "is_out"), plain.select("id", "is_out")).count() == 0
    assert {(r._hot_key, r._salts) for r in skew.heavy_keys(fact, "k", 8).collect()} == {(7, 8)}


def test_salts_follow_the_share_and_are_bounded(spark, tmp_path):
    """100 heavy keys of falling size among many small ones: all salts together stay under twice the slots."""
    rows = spark.range(40_000).select(F.col("id"), F.when(F.col("id") % 4 == 0, F.col("id") + 10**6).otherwise(F.floor(F.sqrt(F.col("id") % 10_000))).alias("k"))
    for slots in (64, 400, 1000):
        heavy = {r._hot_key: r._salts for r in skew.heavy_keys(rows, "k", slots).collect()}
        counts = {r.k: r["count"] for r in rows.groupBy("k").count().collect()}
        assert sum(heavy.values()) <= 2 * slots
        assert all(counts[k] * slots > 0.9 * 40_000 for k in heavy)
        assert {k for k, n in counts.items() if n * slots > 1.2 * 40_000} <= set(heavy)
        assert all(abs(n - 2 * slots * counts[k] / 40_000) <= 2 for k, n in heavy.items())
    rows.write.parquet(str(tmp_path / "f"))
    fact, dim = spark.read.parquet(str(tmp_path / "f")), spark.range(100).select(F.col("id").alias("code"), (F.col("id") % 2 == 0).alias("is_out"))
    joined = skew.salted_join(fact, dim, "k", "code", ["id"], 400)
    assert joined.where("is_out IS NOT NULL").count() == 30_000
    assert planned(joined).count("FileScan parquet [id") == 1  # the sketch is a pass of its own


def test_rows_without_a_key_are_dealt_over_all_slots(spark, conf):
    conf(shuffle__partitions="8", adaptive__enabled="false")
    fact = spark.range(4000).select("id", F.lit(None).cast("int").alias("k"))
    dim = spark.createDataFrame([(1, True)], "code INT, is_out BOOLEAN")
    joined = skew.salted_join(fact, dim, "k", "code", ["id"], 64)
    tasks = joined.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) == 8 and max(r["count"] for r in tasks) < 1000


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_registered_skew_join_is_split(spark, data, sf):
    report = QUERIES["join_skew_adaptive"](spark, str(Path(data).parent / sf))
    assert "skew=true" in executed(report)


def test_bloom_filter_reaches_the_scan(spark, data):
    bloomed = QUERIES["join_filtered_bloom"](spark, data)
    plan = executed(bloomed)
    assert "might_contain" in plan and "BroadcastHashJoin" not in plan and count(plan, "SortMergeJoin") == 1
    li = spark.read.parquet(f"{data}/lineitem.parquet")
    bare = joins.filter_session(spark, scan_bytes=1)
    bare.conf.set("spark.sql.optimizer.runtime.bloomFilter.enabled", "false")
    o = bare.read.parquet(f"{data}/orders.parquet")
    rare = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_custkey") % 50 == 0)
    unfiltered = joins.join_rare(bare.read.parquet(f"{data}/lineitem.parquet").select("l_orderkey"), o, F.col("l_orderkey") == F.col("o_orderkey"), rare)
    assert shuffled_rows(unfiltered)[0] == li.count()
    assert shuffled_rows(bloomed)[0] < 0.1 * li.count()


def shuffled_rows(df):
    """Records that each shuffle wrote, the most first."""
    df.rdd.count()
    return sorted(shuffle_records(df), reverse=True)


def test_each_cut_of_the_sweep_runs_once(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(skew, "stored", lambda df, label="": kept.append((label, planned(df))) or stored(df, label))
    skew.partition_sweep(spark.range(50).select((F.col("id") % 2).alias("k"), F.col("id").cast("double").alias("v")), "k", "v", [2, 5])
    assert [label for label, _ in kept] == ["sweep-input", "sweep", "sweep"]
    for _, plan in kept[1:]:
        assert plan.split("== Initial Plan ==")[0].count("REPARTITION_BY_NUM") == 1 and plan.count("CollectMetrics") >= 1


def test_partition_sizes_query_looks_at_the_hottest_key(spark, data):
    row = QUERIES["partition_sizes"](spark, data).first()
    assert row.holds_hottest is True and row.partitions == 8
