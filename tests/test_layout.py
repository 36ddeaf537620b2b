import time

from pyspark.sql import functions as F

from millrace.operators.aggregates import entity_avg, month_count
from millrace.operators.facts import with_dates
from millrace.plans import QUERIES, inputs
from millrace.sources import layout
from millrace.sources.footers import parquet_footers
from tests.plan_text import files_read, planned


def files_in(path, pattern="part-*"):
    return list(path.rglob(pattern))


def test_file_counts(spark, tmp_path):
    df = spark.range(1000)
    layout.write_files(df, str(tmp_path / "many"), 20)
    layout.write_files(df, str(tmp_path / "few"), 2, shuffle=False)
    assert len(files_in(tmp_path / "many")) == 20
    assert len(files_in(tmp_path / "few")) == 2
    assert spark.read.parquet(str(tmp_path / "many")).count() == 1000


def test_as_many_tasks_as_asked(spark):
    few = spark.range(1000).coalesce(1)
    assert layout.in_files(few, 4, shuffle=False).rdd.getNumPartitions() == 4
    assert layout.in_files(spark.range(1000), 3).rdd.getNumPartitions() == 3


def test_spread_only_moves_small_scans(spark, tmp_path, conf):
    cores = spark.sparkContext.defaultParallelism
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "one"))
    spark.range(100).repartition(3 * cores).write.parquet(str(tmp_path / "many"))
    conf(files__openCostInBytes=str(128 << 20))
    one, many = (spark.read.parquet(str(tmp_path / n)) for n in ("one", "many"))
    assert layout.spread(one).rdd.getNumPartitions() == cores
    assert "Exchange" not in planned(layout.spread(many))


def test_dim_is_one_file(spark, tmp_path):
    layout.write_dim(spark.range(10_000).select((F.col("id") % 7).alias("k")).distinct(), str(tmp_path / "d"))
    assert len(files_in(tmp_path / "d")) == 1


def test_month_and_date_folders(spark, tmp_path):
    days = spark.range(200).select(F.expr("timestampadd(DAY, id, TIMESTAMP_NTZ '2024-01-01 10:00:00')").alias("ts"))
    fact = with_dates(days, "ts")
    layout.write_partitioned(fact, str(tmp_path / "m"), ["game_month"])
    layout.write_partitioned(fact, str(tmp_path / "d"), ["game_date"])
    assert len(files_in(tmp_path / "m", "game_month=*")) == 7
    assert len(files_in(tmp_path / "d", "game_date=*")) == 200 == layout.folder_count(fact, ["game_date"]).first()[0]
    for name, folders, month in (("m", "game_month", "game_month"), ("d", "game_date", "month(game_date")):
        july = month_count(spark, str(tmp_path / name), 7, folders)
        assert july.first().n == 18
        assert f"PartitionFilters: [isnotnull({folders}" in planned(july) and month in planned(july)
        july.rdd.count()
        assert files_read(july) == (1 if name == "m" else 18)
    assert month_count(spark, str(tmp_path / "m"), 7).first().n == 18


def test_clustered_files_are_skipped_by_their_statistics(spark, tmp_path):
    rows = spark.range(20_000).select(F.pmod(F.xxhash64("id"), F.lit(100)).alias("who"), F.col("id").cast("double").alias("v"))
    layout.write_clustered(rows, str(tmp_path / "by"), ["who"], 10)
    layout.write_files(rows, str(tmp_path / "flat"), 10)
    groups = {}
    for name in ("by", "flat"):
        footers = parquet_footers(spark, str(tmp_path / name), ["who"])
        groups[name] = footers.where("CAST(min AS INT) <= 42 AND CAST(max AS INT) >= 42").count()
        assert "PushedFilters: [IsNotNull(who), EqualTo(who,42)]" in planned(entity_avg(spark, str(tmp_path / name), "who", "v", 42))
    assert groups == {"by": 1, "flat": 10}
    want = entity_avg(spark, str(tmp_path / "flat"), "who", "v", 42).first()
    assert abs(entity_avg(spark, str(tmp_path / "by"), "who", "v", 42).first().avg_value - want.avg_value) < 1e-6


def test_hot_folder_is_written_by_several_tasks(spark, tmp_path, conf):
    conf(adaptive__advisoryPartitionSizeInBytes="20KB")
    hot = spark.range(40_000).select(F.lit(1).alias("k"), F.hash("id").alias("v"))
    layout.write_partitioned(hot.repartition(8), str(tmp_path / "h"), ["k"])
    assert len(files_in(tmp_path / "h")) > 1


def test_codecs(spark, data, tmp_path):
    li = spark.read.parquet(f"{data}/lineitem.parquet")
    sizes = {r.format: r for r in layout.codec_sweep(li, str(tmp_path)).collect()}
    assert set(sizes) == set(layout.CODECS)
    assert sizes["parquet_zstd"].bytes < sizes["parquet_none"].bytes
    assert all(r.ratio > 1 and r.rows == li.count() and r.files == 4 for r in sizes.values())
    for name in ("csv_gzip", "parquet_gzip"):
        reader = spark.read.option("header", True).csv if name.startswith("csv") else spark.read.parquet
        assert reader(str(tmp_path / name)).count() == li.count()


def test_small_files(spark, tmp_path):
    layout.split_small(spark.range(1000), 100, 25, str(tmp_path / "s"))
    assert len(files_in(tmp_path / "s")) == 25
    ids = spark.read.schema("id BIGINT").option("header", True).csv(str(tmp_path / "s"))
    assert ids.agg(F.count("*"), F.max("id")).first()[:] == (100, 99)


def test_spread_leaves_tables_with_splits_for_half_of_the_cores(spark, tmp_path, conf):
    cores = spark.sparkContext.defaultParallelism
    conf(files__openCostInBytes=str(128 << 20))
    spark.range(100).repartition(cores - 1).write.parquet(str(tmp_path / "most"))
    assert "Exchange" not in planned(layout.spread(spark.read.parquet(str(tmp_path / "most"))))


def test_flat_fact_is_written_without_a_shuffle(spark, tmp_path, conf):
    conf(files__openCostInBytes=str(128 << 20))
    rows = spark.range(400).select("id", F.expr("timestampadd(DAY, id, TIMESTAMP_NTZ '2024-01-01 10:00:00')").alias("l_shipdate"))
    rows.repartition(20).write.parquet(str(tmp_path / "lineitem.parquet"))
    flat = spark.read.parquet(inputs.flat_fact(spark, str(tmp_path)))
    assert len(flat.inputFiles()) == 20 and flat.count() == 400


def test_clustered_files_grow_with_the_table():
    assert [layout.files_for(b << 20, 8) for b in (1, 256, 640, 3840)] == [8, 8, 20, 120]


def test_codecs_are_written_side_by_side(spark, tmp_path, monkeypatch):
    writer, running, most = type(spark.range(1).write), [], []
    real = writer.save

    def save(self, *args, **options):
        running.append(1)
        most.append(len(running))
        time.sleep(0.5)
        real(self, *args, **options)
        running.pop()

    monkeypatch.setattr(writer, "save", save)
    rows = {r.format: (r.rows, r.files) for r in layout.codec_sweep(spark.range(5000), str(tmp_path)).collect()}
    assert rows == {name: (5000, 4) for name in layout.CODECS}
    assert max(most) > 1


def test_few_files_are_alike_in_size(spark, tmp_path, conf):
    conf(files__openCostInBytes=str(128 << 20))
    path = str(tmp_path / "lineitem.parquet")
    spark.range(20_000).coalesce(1).write.parquet(path)
    spark.range(70).repartition(7).write.mode("append").parquet(path)
    got = QUERIES["sink_file_counts"](spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == [(4, 20_070), (400, 20_070)]
    few = [f for f in got.inputFiles() if "/4/" in f]
    sizes = [spark.read.parquet(f).count() for f in few]
    assert len(few) == 4 and max(sizes) < 2 * min(sizes)
