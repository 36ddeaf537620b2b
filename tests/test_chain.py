"""Raw files to fact, dimensions and reports, the way the jobs follow each other."""

from pyspark.sql import functions as F

from millrace.operators import aggregates as agg
from millrace.operators import facts, joins
from millrace.sources import files, guards, layout

RAW = """pitch_type,game_date,release_speed,release_spin_rate,player_name,game_pk,at_bat_number,des,events,batter,pitcher,home_team
FF,2025-07-01,97.5,2300,"Doe, Jo",1,1,Jo Doe throws.,,7,99,ATL
FF,2025-07-01,95.0,2500,"Doe, Jo",1,1,Jo Doe strikes out Ann.,strikeout,7,99,ATL
SL,2025-07-02,88.1,2600,"Roe, Al",2,1,Home run by Bo.,home_run,8,98,SEA
,2025-08-02,,,"Roe, Al",2,2, ,single,8,98,SEA
ZZ,2025-08-03,96.0,2100,"Poe, Ed",3,1,Walk.,walk,9,97,XXX
"""


def test_chain(spark, tmp_path):
    (tmp_path / "season.csv").write_text(RAW)
    raw = files.scan_csv(spark, str(tmp_path / "season.csv"), infer=True)
    fact_path = str(tmp_path / "fact")
    layout.write_files(guards.require_rows(facts.with_dates(raw, "game_date"), 5), fact_path, 8)
    fact = guards.read_required(spark, fact_path)
    assert dict(fact.dtypes)["game_date"] == "date" and dict(fact.dtypes)["game_month"] == "int"

    summary = {r.pitch_type: (r.n, r.avg_speed) for r in agg.summary_by(fact, "pitch_type", "release_speed", "avg_speed").collect()}
    assert summary == {"FF": (2, 96.3), "SL": (1, 88.1), "ZZ": (1, 96.0), None: (1, None)}
    assert agg.month_count(spark, fact_path, 7).first().n == 3
    assert agg.entity_avg(spark, fact_path, "pitcher", "release_spin_rate", 99).first().avg_value == 2400.0

    fast = ("pitch_type", "release_speed", "release_spin_rate", 95.0)
    lines = files.scan_text(spark, str(tmp_path / "season.csv"))
    schema = ", ".join(f"{name} {'DOUBLE' if name.startswith('release') else 'STRING'}" for name in RAW.split("\n")[0].split(","))
    parsed = files.parse_csv_lines(lines, schema, ["release_speed", "release_spin_rate"])
    ways = [agg.fast_sql(fact, *fast), agg.fast_df(fact, *fast), agg.fast_df(raw, *fast), agg.fast_udf(fact, *fast), agg.fast_pairs(parsed, *fast)]
    assert {frozenset(map(tuple, w.collect())) for w in ways} == {frozenset({("FF", 2, 2400.0), ("ZZ", 1, 2100.0)})}

    pa = facts.plate_appearances(fact)
    assert agg.table_ratio(fact, pa).first().low
    texts = facts.build_corpus(fact, "des", ["game_pk", "at_bat_number"])
    assert texts.count() == 3

    for name, dim in {"teams": facts.teams_dim(spark), "types": facts.pitch_type_dim(fact), "outcomes": facts.outcome_dim(fact)}.items():
        layout.write_dim(dim, str(tmp_path / name))
    teams, types, outcomes = (spark.read.parquet(str(tmp_path / n)) for n in ("teams", "types", "outcomes"))
    assert (teams.count(), types.count(), outcomes.count()) == (30, 3, 4)

    home = joins.join_dim(fact, teams, fact.home_team == teams.team)
    assert {(r.league, r.n) for r in home.groupBy("league").agg(F.count("*").alias("n")).collect()} == {("NL", 2), ("AL", 2)}
    assert [r.home_team for r in joins.unmatched(fact, teams, fact.home_team == teams.team).collect()] == ["XXX"]
    flags = joins.by_flag(joins.join_outcome(fact, outcomes.withColumnRenamed("events", "code"), "events", "code"), "is_out", "release_speed")
    assert {(r.is_out, r.n) for r in flags.collect()} == {(None, 1), (True, 1), (False, 3)}
