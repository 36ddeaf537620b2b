import pytest
from pyspark.sql import functions as F

from millrace.functions.columns import clean, not_blank
from millrace.operators import facts
from millrace.operators.events import pitch_events, trim_events
from millrace.sources.files import scan_events
from millrace.sources.guards import MissingColumns
from tests.plan_text import count, planned

PITCHES = [
    # game, at-bat, outcome, batter, home, pitch, speed, text
    (1, 1, None, 7, "ATL", "FF", 95.0, "a"),
    (1, 1, "single", 7, "ATL", "SL", 88.0, "b"),
    (1, 1, "single", 7, "ATL", "CH", 80.0, "b2"),
    (1, 2, "strikeout", 8, "ATL", "ZZ", None, "  "),
    (2, 1, "sac_fly", 9, "XXX", None, 90.0, None),
]
DDL = "game_pk INT, at_bat_number INT, events STRING, batter INT, home_team STRING, pitch_type STRING, release_speed DOUBLE, des STRING"


@pytest.fixture(scope="module")
def pitches(spark):
    return spark.createDataFrame(PITCHES, DDL)


def test_plate_appearances(pitches):
    pa = facts.plate_appearances(pitches)
    assert pa.columns == ["game_pk", "at_bat_number", "events", "des", "batter", "home_team", "release_speed", "pitch_type"]
    rows = sorted((r.game_pk, r.at_bat_number, r.des or "") for r in pa.collect())
    assert rows == [(1, 1, "b"), (1, 2, "  "), (2, 1, "")]
    with pytest.raises(MissingColumns):
        facts.plate_appearances(pitches.drop("batter"))


def test_dims(spark, pitches):
    teams = facts.teams_dim(spark)
    assert teams.count() == teams.select("team").distinct().count() == 30
    types = {r.pitch_type: (r.pitch_label, r.pitch_family) for r in facts.pitch_type_dim(pitches).collect()}
    assert types == {
        "FF": ("Four-Seam Fastball", "fastball"),
        "SL": ("Slider", "breaking"),
        "CH": ("Changeup", "offspeed"),
        "ZZ": ("Unclassified (ZZ)", "other"),
    }
    outcomes = {r.events: (r.is_out, r.is_hit) for r in facts.outcome_dim(pitches).collect()}
    assert outcomes == {"single": (False, True), "strikeout": (True, False), "sac_fly": (True, False)}


def test_corpus(pitches):
    texts = facts.build_corpus(pitches, "des", ["game_pk", "at_bat_number"])
    assert sorted(r.des for r in texts.collect()) == ["a"]
    assert not pitches.where(not_blank("des") & (F.col("game_pk") == 2)).count()


def test_dedup_drops_copies_before_the_shuffle(spark, pitches):
    one = facts.dedup(pitches, ["game_pk"])
    assert one.count() == 2
    assert count(planned(one), "WindowGroupLimit") == 2
    copies = spark.createDataFrame([(1,)] * 5, "n INT")
    assert facts.dedup(copies, ["n"]).count() == 1


def test_udf_filter_hides_the_predicate(spark, data):
    li = spark.read.parquet(f"{data}/lineitem.parquet").select("l_quantity")
    seen, hidden = li.where("l_quantity >= 40"), facts.udf_filter(li, "l_quantity", 40.0)
    assert seen.count() == hidden.count()
    assert "GreaterThanOrEqual(l_quantity,40.0)" in planned(seen)
    assert "PushedFilters: []" in planned(hidden)
    nulls = spark.createDataFrame([(None,), (50.0,)], "v DOUBLE")
    assert [r.v for r in facts.udf_filter(nulls, "v", 40.0).collect()] == [50.0]


def test_clean(spark):
    df = spark.createDataFrame([(" a\tb\n",), ("\t\n",), (None,), ("",)], "s STRING")
    assert [r[0] for r in df.select(clean(F.col("s"), "none")).collect()] == ["a b", "none", "none", "none"]


def test_trim_events_defaults(spark, tmp_path):
    (tmp_path / "e.json").write_text('{"id":"9","repo":{"name":"a\\tb\\nc"},"payload":{"k":1}}\n{}\n')
    raw = scan_events(spark, str(tmp_path))
    rows = {r.entity: r for r in trim_events(raw).collect()}
    assert rows["a b c"].value == (
        '{"id":"9","type":"UnknownEvent","actor":"unknown","repo":"a b c",'
        '"created_at":"1970-01-01T00:00:00Z","public":true,"payload_bytes":7}'
    )
    assert '"id":"0"' in rows["unknown/unknown"].value and '"payload_bytes":2' in rows["unknown/unknown"].value


def test_pitch_events_ids(spark):
    df = spark.createDataFrame(
        [("5", None, None, "", None), ("6", "p1", "SL", "77", "2024-05-01")],
        "game_pk STRING, pitch_id STRING, pitch_type STRING, pitcher STRING, game_date STRING",
    )
    rows = {r.entity: r for r in pitch_events(df, "game_pk", "pitch_type", "pitcher", "game_date", ident=["pitch_id"]).collect()}
    assert rows["5"].type == "UN"
    assert '"id":"5-0"' in rows["5"].value and '"created_at":"1970-01-01T00:00:00Z"' in rows["5"].value
    assert '"id":"p1"' in rows["6"].value and '"actor":"77"' in rows["6"].value
