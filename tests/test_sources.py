import gzip

import pytest
from pyspark.sql import functions as F

from millrace.operators.events import trim_events
from millrace.sources import files, guards
from millrace.sources.footers import parquet_footers

RAW = [
    '{"id":"1","type":"Push","actor":{"login":"ann"},"repo":{"name":"a/b"},"created_at":"t","public":false,"payload":{"x":[1,2]}}',
    "",
    '{"id":"2","type":',
    "   ",
    "not json",
    '{"id":"3"}',
]


def test_csv_inferred_and_strings(spark, tmp_path):
    (tmp_path / "a.csv").write_text('n,name,x\n1,"Doe, Jo",2.5\n2,,\n')
    inferred = files.scan_csv(spark, str(tmp_path), infer=True)
    assert [f.dataType.simpleString() for f in inferred.schema] == ["int", "string", "double"]
    assert [tuple(r) for r in inferred.orderBy("n").collect()] == [(1, "Doe, Jo", 2.5), (2, None, None)]
    assert {f.dataType.simpleString() for f in files.scan_csv(spark, str(tmp_path)).schema} == {"string"}


def test_gzip_csv_is_one_task_per_file(spark, tmp_path, conf):
    conf(files__maxPartitionBytes="1000", files__openCostInBytes="1")
    body = "n\n" + "".join(f"{i}\n" for i in range(5000))
    (tmp_path / "plain.csv").write_text(body)
    with gzip.open(tmp_path / "packed.csv.gz", "wt") as f:
        f.write(body)
    plain = files.scan_csv(spark, str(tmp_path / "plain.csv"), schema="n INT")
    packed = files.scan_csv(spark, str(tmp_path / "packed.csv.gz"), schema="n INT")
    assert plain.rdd.getNumPartitions() > 1
    assert packed.rdd.getNumPartitions() == 1
    assert packed.count() == plain.count() == 5000


def test_quoted_lines(spark):
    lines = [
        "type,name,speed",
        'FF,"Last, First",95.5',
        "SL,Solo,nope",
        "CH,Short",
        "type,name,speed",
        ",NoType,90",
        "CU,\"Say \"\"hi\"\"\",80",
    ]
    df = spark.createDataFrame([(v,) for v in lines], "value STRING")
    rows = files.parse_csv_lines(df, "type STRING, name STRING, speed DOUBLE", ["speed"]).collect()
    assert {(r.type, r.speed) for r in rows} == {("FF", 95.5), (None, 90.0), ("CU", 80.0)}
    assert next(r.name for r in rows if r.type == "FF") == "Last, First"


def test_text_reader_is_pinned_but_grows(spark, tmp_path, conf):
    spark.range(40).select(F.col("id").cast("string")).repartition(40).write.text(str(tmp_path / "t"))
    conf(files__openCostInBytes="128MB")
    path = str(tmp_path / "t")
    splits = spark.read.text(path).rdd.getNumPartitions()
    assert splits > 16
    assert files.scan_text(spark, path).rdd.getNumPartitions() == 8
    assert files.scan_text(spark, path, splits_per_task=2).rdd.getNumPartitions() == -(-splits // 2)


def test_text_tasks_read_five_splits_at_most(spark, tmp_path, conf):
    spark.range(100).select(F.col("id").cast("string")).repartition(100).write.text(str(tmp_path / "t"))
    conf(files__openCostInBytes="128MB")
    lines = files.scan_text(spark, str(tmp_path / "t"))
    per_task = lines.groupBy(F.spark_partition_id()).agg(F.count_distinct("_metadata.file_path").alias("n"))
    assert per_task.agg(F.max("n")).first()[0] <= 5
    assert lines.count() == 100


def test_bad_event_lines_go(spark, tmp_path):
    with gzip.open(tmp_path / "hour.json.gz", "wt") as f:
        f.write("\n".join(RAW) + "\n")
    events = files.scan_events(spark, str(tmp_path))
    assert sorted(r.id for r in events.collect()) == ["1", "3"]
    assert events.agg(F.count("*")).first()[0] == 2
    assert events.where("id = '1'").first().payload == '{"x":[1,2]}'


def test_wrong_typed_fields_keep_their_rows(spark, tmp_path):
    lines = ['{"id":1,"public":"yes"}', '{"id":"2","actor":"bob","public":null}', '{"id":"3","public":false,"payload":{"t":"é"}}', '{"id":"4","repo":5,"public":0}', "[1]", '"x"', "7"]
    (tmp_path / "e.json").write_text("\n".join(lines))
    events = files.scan_events(spark, str(tmp_path))
    rows = {r.id: r for r in events.collect()}
    assert {i: r.public for i, r in rows.items()} == {"1": True, "2": False, "3": False, "4": False}
    assert rows["2"].actor.login is None and rows["4"].repo.name is None
    for columns in (["id"], ["id", "public"], events.columns):
        assert len(events.select(columns).collect()) == 4
    sizes = {r.id: r.payload_bytes for r in trim_events(events).select(F.from_json("value", "id STRING, payload_bytes INT").alias("v")).select("v.*").collect()}
    assert sizes == {"1": 2, "2": 2, "3": 10, "4": 2}


def test_replay_file_keeps_json(spark, tmp_path):
    (tmp_path / "r.tsv").write_text('a/b\tPush\t{"id":"1","note":"say \\"hi\\", x"}\n')
    assert tuple(files.scan_replay(spark, str(tmp_path)).first()) == ("a/b", "Push", '{"id":"1","note":"say \\"hi\\", x"}')


def test_seasons(spark, tmp_path):
    (tmp_path / "a.csv").write_text("des,game_pk\nx,1\ny,2\n")
    (tmp_path / "b.csv").write_text("des,game_pk\nz,3\n")
    paths = [str(tmp_path / n) for n in ("a.csv", "b.csv")]
    args = (spark, paths, "des STRING, game_pk INT")
    (tmp_path / "turned.csv").write_text("game_pk,des\n4,w\n")
    with pytest.raises(guards.WrongHeader, match="turned.csv"):
        files.ingest_seasons(spark, [*paths, str(tmp_path / "turned.csv")], args[2], ["des"], 1)
    (tmp_path / "short.csv").write_text("des\nq\n")
    with pytest.raises(guards.MissingColumns, match="game_pk.*short.csv"):
        files.ingest_seasons(spark, [*paths, str(tmp_path / "short.csv")], args[2], ["des", "game_pk"], 1)
    assert files.ingest_seasons(*args, ["des"], 3).count() == 3
    with pytest.raises(guards.MissingColumns) as e:
        files.ingest_seasons(*args, ["pitch_type", "des", "at_bat"], 1)
    assert e.value.columns == ["at_bat", "pitch_type"]
    with pytest.raises(guards.TooFewRows):
        files.ingest_seasons(*args, ["des"], 4)
    with pytest.warns(UserWarning):
        guards.require_rows(spark.range(2), 3, only_warn=True)


def test_missing_input(spark, tmp_path):
    with pytest.raises(guards.MissingInput):
        guards.read_required(spark, str(tmp_path / "absent"))


def test_materialise_builds_once(spark, tmp_path):
    built = []

    def build():
        built.append(1)
        return spark.range(3)

    for _ in range(2):
        assert guards.materialise(spark, build, str(tmp_path / "t")).count() == 3
    assert built == [1]


def test_headers_of_many_files_in_one_job(spark, tmp_path):
    for i in range(1000):
        (tmp_path / f"s{i:04}.csv").write_text(("game_pk,des\n" if i == 777 else '"des",game_pk\r\n') + f"x{i},{i}\n")
    context = spark.sparkContext
    context.setJobGroup("headers", "headers")
    with pytest.raises(guards.WrongHeader) as e:
        files.ingest_seasons(spark, [str(tmp_path)], "des STRING, game_pk INT", ["des"], 1)
    jobs = context.statusTracker().getJobIdsForGroup("headers")
    context.setLocalProperty("spark.jobGroup.id", None)
    assert [p.rsplit("/", 1)[-1] for p in e.value.paths] == ["s0777.csv"]
    assert len(jobs) <= 3  # stages of one query; the listing of many files is a job of its own


def test_a_died_build_is_built_again(spark, tmp_path):
    path = tmp_path / "t"
    (path / "data-0" / "_temporary" / "0").mkdir(parents=True)  # left by a build that never ended
    (path / "_temporary").mkdir()
    assert guards.materialise(spark, lambda: spark.range(3), str(path)).count() == 3
    assert guards.materialise(spark, lambda: spark.range(9), str(path)).count() == 3

    def dies():
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        guards.materialise(spark, dies, str(tmp_path / "u"))
    assert guards.materialise(spark, lambda: spark.range(2), str(tmp_path / "u")).count() == 2


def test_two_builders_at_once_publish_one_table(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor
    from threading import Barrier

    start = Barrier(2)

    def build(n):
        start.wait(30)
        return spark.range(100).withColumn("by", F.lit(n))

    with ThreadPoolExecutor(2) as pool:
        tables = list(pool.map(lambda n: guards.materialise(spark, lambda: build(n), str(tmp_path / "t")), range(2)))
    assert all(t.count() == 100 and t.select("by").distinct().count() == 1 for t in tables)
    later = guards.materialise(spark, lambda: spark.range(1), str(tmp_path / "t"))
    assert later.count() == 100


def test_schema_and_size(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "x")], "n INT, s STRING")
    assert [tuple(r) for r in files.schema_of(df).orderBy("position").collect()] == [(0, "n", "int", 2), (1, "s", "string", 1)]
    df.repartition(2).write.parquet(str(tmp_path / "t"))
    size = files.path_size(spark, str(tmp_path / "t")).first()
    parts = [p for p in (tmp_path / "t").iterdir() if p.name.startswith("part-")]
    assert (size.files, size.bytes) == (len(parts), sum(p.stat().st_size for p in parts))


def test_footers(spark, tmp_path):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else f"v{i % 3}") for i in range(100)], "n INT, s STRING")
    df.repartition(3).write.parquet(str(tmp_path / "t"))
    rows = parquet_footers(spark, str(tmp_path / "t"))
    assert rows.select("file").distinct().count() == 3
    total = rows.groupBy("column").agg(F.sum("group_rows").alias("n"), F.sum("null_count").alias("nulls"))
    assert {tuple(r) for r in total.collect()} == {("n", 100, 0), ("s", 100, 25)}
    n = rows.where("column = 'n'").agg(F.min(F.col("min").cast("int")), F.max(F.col("max").cast("int"))).first()
    assert tuple(n) == (0, 99)
    assert {r.codec for r in rows.select("codec").distinct().collect()} == {"SNAPPY"}
    assert parquet_footers(spark, str(tmp_path / "t"), ["s"]).select("column").distinct().count() == 1
