"""Queries on joins and skew."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import joins, skew
from millrace.operators.joins import by_flag, checked_broadcast
from millrace.plans import inputs
from millrace.plans.aggs import FLAG_SQL
from millrace.plans.registry import query, rounded, table
from millrace.sources.files import path_size

FACTS_SQL = """
SELECT l_orderkey, l_linenumber, l_quantity, o_orderpriority, o_totalprice
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""
RARE_SQL = FACTS_SQL + " WHERE o_orderpriority = '1-URGENT' AND o_custkey % 50 = 0"


def _facts(spark, data):
    li = table(spark, data, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    o = table(spark, data, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    return li, o, li.l_orderkey == o.o_orderkey


def _narrow(joined):
    return joined.select("l_orderkey", "l_linenumber", "l_quantity", "o_orderpriority", "o_totalprice")


def _flag_inputs(spark, data):
    return inputs.skewed_events(spark, data), spark.read.parquet(inputs.outcomes(spark, data))


def _flags(joined):
    return rounded(by_flag(joined, "is_out", "value"), "avg_value")


@query(
    "join_dim_broadcast",
    """
SELECT n_name, r_name, count(*) AS n, round(avg(l_quantity), 6) AS avg_value
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY n_name, r_name
""",
)
def join_dim_broadcast(spark, data):
    li = table(spark, data, "lineitem").select("l_suppkey", "l_quantity")
    s = table(spark, data, "supplier").select("s_suppkey", "s_nationkey")
    n, r = table(spark, data, "nation"), table(spark, data, "region")
    groups = joins.join_dim(n, r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")
    owned = joins.join_dim(li, s, li.l_suppkey == s.s_suppkey)
    named = joins.join_dim(owned, groups, owned.s_nationkey == groups.n_nationkey)
    report = named.groupBy("n_name", "r_name").agg(F.count("*").alias("n"), F.avg("l_quantity").alias("avg_value"))
    return rounded(report, "avg_value")


@query("join_fact_merge", FACTS_SQL)
def join_fact_merge(spark, data):
    return _narrow(joins.join_facts(*_facts(spark, data), strategy="merge"))


@query("join_fact_shuffle_hash", FACTS_SQL)
def join_fact_shuffle_hash(spark, data):
    return _narrow(joins.join_facts(*_facts(spark, data), strategy="shuffle_hash"))


@query("join_filtered_adaptive", RARE_SQL)
def join_filtered_adaptive(spark, data):
    rare = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_custkey") % 50 == 0)
    return _narrow(joins.join_rare(*_facts(spark, data), rare))


@query("join_filtered_bloom", RARE_SQL)
def join_filtered_bloom(spark, data):
    """The rare side counts as too large for a broadcast: a Bloom filter of its keys reaches the fact's scan."""
    session = joins.filter_session(spark, scan_bytes=1)
    rare = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_custkey") % 50 == 0)
    return _narrow(joins.join_rare(*_facts(session, data), rare))


@query("join_left_nullkey", FLAG_SQL)
def join_left_nullkey(spark, data):
    fact, dim = _flag_inputs(spark, data)
    return _flags(joins.join_outcome_apart(fact, dim, "k", "event_type"))


@query("join_inner_nullkey", FLAG_SQL.replace("LEFT JOIN", "JOIN"))
def join_inner_nullkey(spark, data):
    fact, dim = _flag_inputs(spark, data)
    return _flags(joins.join_outcome(fact, dim, "k", "event_type", "inner"))


@query("join_left_broadcast", FLAG_SQL)
def join_left_broadcast(spark, data):
    fact, dim = _flag_inputs(spark, data)
    return _flags(joins.join_outcome(fact, checked_broadcast(dim), "k", "event_type"))


@query("join_salted", f"SELECT s.salts, f.* FROM ({FLAG_SQL}) f, (VALUES (4), (16), (64)) s(salts)")
def join_salted(spark, data):
    fact, dim = _flag_inputs(spark, data)
    sweep = skew.salt_sweep(fact, dim, "k", "event_type", ["event_id", "user_id"], "value", "is_out")
    return rounded(sweep, "avg_value")


@query("join_skew_adaptive", FLAG_SQL)
def join_skew_adaptive(spark, data):
    path = inputs.skewed_fact(spark, data)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    average = skew.skew_bytes(path_size(spark, path).first()["bytes"], partitions)
    session = skew.skew_session(spark, partition_bytes=average, factor=1.5, advisory=average)
    fact, dim = session.read.parquet(path), session.read.parquet(inputs.outcomes(spark, data))
    return _flags(skew.skew_join(fact, dim, "k", "event_type"))


@query(
    "join_same_result",
    """
SELECT s.salts, count(*) AS rows_plain, count(*) AS rows_salted, 0::BIGINT AS rows_differ
FROM events, (VALUES (4), (16), (64)) s(salts) GROUP BY s.salts
""",
)
def join_same_result(spark, data):
    fact, dim = _flag_inputs(spark, data)
    plain = joins.join_outcome_apart(fact, dim, "k", "event_type").select("event_id", "is_out")
    counted = []
    for n in (4, 16, 64):
        salted = skew.salted_join(fact, dim, "k", "event_type", ["event_id", "user_id"], n).select("event_id", "is_out")
        rows = plain.withColumn("_plain", F.lit(True)).unionByName(salted.withColumn("_plain", F.lit(False)))
        sides = rows.groupBy("event_id", "is_out").agg(F.count_if("_plain").alias("a"), F.count_if(~F.col("_plain")).alias("b"))
        sums = [F.sum("a").alias("rows_plain"), F.sum("b").alias("rows_salted"), F.sum(F.abs(F.col("a") - F.col("b"))).alias("rows_differ")]
        counted.append(sides.agg(*sums).select(F.lit(n).alias("salts"), "rows_plain", "rows_salted", "rows_differ"))
    return reduce(DataFrame.unionByName, counted)


@query(
    "join_unmatched",
    """
SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)
""",
)
def join_unmatched(spark, data):
    c, o = table(spark, data, "customer"), table(spark, data, "orders")
    keys = o.select("o_custkey")
    return joins.unmatched(c, keys, c.c_custkey == keys.o_custkey).select("c_custkey", "c_name")


@query(
    "repartition_sweep",
    """
SELECT p.partitions, p.partitions::BIGINT AS used, l_returnflag, count(*) AS n, round(avg(l_quantity), 6) AS avg_value
FROM lineitem, (VALUES (1), (2), (4), (8), (32), (200), (1000)) p(partitions) GROUP BY p.partitions, l_returnflag
""",
)
def repartition_sweep(spark, data):
    sweep = skew.partition_sweep(
        table(spark, data, "lineitem"), "l_returnflag", "l_quantity", [1, 2, 4, 8, 32, 200, 1000]
    )
    return rounded(sweep, "avg_value")


K_SQL = "(SELECT CASE WHEN event_id % 4 = 0 THEN event_type END AS k FROM events)"


@query(
    "partition_sizes",
    f"SELECT 8::BIGINT AS partitions, count(*) AS n, true AS holds_hottest FROM {K_SQL}",
)
def partition_sizes(spark, data):
    """Which partition gets what is the hash's choice; their number, their sum, and that one holds the hottest key are not."""
    events = inputs.skewed_events(spark, data)
    hottest = events.groupBy("k").agg(F.count("*").alias("n")).agg(F.max("n")).scalar()
    sizes = skew.partition_sizes(events, "k", 8)
    return sizes.agg(F.count("*").alias("partitions"), F.sum("n").alias("n"), (F.max("n") >= hottest).alias("holds_hottest"))


@query(
    "key_profile",
    """
WITH c AS (SELECT k, count(*) AS c FROM (SELECT CASE WHEN event_id % 4 = 0 THEN event_type END AS k FROM events) GROUP BY k)
SELECT 'k' AS key, count(*) AS distinct_keys, (SELECT k FROM c ORDER BY c DESC, k NULLS FIRST LIMIT 1) AS hottest_key,
       max(c) AS hottest_rows, median(c) AS median_rows, round(max(c) / median(c), 2) AS skew_ratio FROM c
""",
)
def key_profile(spark, data):
    return skew.key_profile(inputs.skewed_events(spark, data), "k")


@query("partition_profile", f"SELECT 'k' AS key, count(*) AS n_rows, count(*) AS one_partition FROM {K_SQL}")
def partition_profile(spark, data):
    """Rows over 16 partitions, and over a single one: there the profile does not depend on the hash."""
    events = inputs.skewed_events(spark, data)
    one = skew.partition_profile(events, "k", 1).select(F.col("key").alias("_key"), F.col("max_rows").alias("one_partition"))
    profile = skew.partition_profile(events, "k", 16)
    return profile.join(one, F.col("key") == F.col("_key")).select("key", "n_rows", "one_partition")


@query(
    "fair_share",
    """
WITH c AS (
  SELECT 'user_id' AS key, count(*) AS c FROM events GROUP BY user_id UNION ALL
  SELECT 'k', count(*) FROM (SELECT CASE WHEN event_id % 4 = 0 THEN event_type END AS k FROM events) GROUP BY k)
SELECT key, sum(c)::DOUBLE / 16 AS fair_share, max(c) AS hottest_rows, round(max(c) / (sum(c)::DOUBLE / 16), 2) AS hottest_shares
FROM c GROUP BY key
""",
)
def fair_share(spark, data):
    return skew.fair_share(inputs.skewed_events(spark, data), ["user_id", "k"], 16)


_KEYS_SQL = " UNION ALL ".join(
    f"SELECT '{k}' AS key, {k}::VARCHAR AS value, count(*) AS n FROM (SELECT user_id, event_id, CASE WHEN event_id % 4 = 0 THEN event_type END AS k FROM events) GROUP BY {k}"
    for k in ("user_id", "k", "event_id")
)


@query(
    "profile_keys",
    f"""
WITH c AS ({_KEYS_SQL})
SELECT key, count(*) AS distinct_keys, (SELECT value FROM c x WHERE x.key = c.key ORDER BY n DESC, value NULLS FIRST LIMIT 1) AS hottest_key,
       max(n) AS hottest_rows, median(n) AS median_rows, round(max(n) / median(n), 2) AS skew_ratio, true AS fits
FROM c GROUP BY key
""",
)
def profile_keys(spark, data):
    """Both profiles of three keys. The partitions are the hash's choice, but no more of them have rows than there are keys and the largest holds the hottest key's rows."""
    both = skew.profile_keys(inputs.skewed_events(spark, data), ["user_id", "k", "event_id"], 16)
    fits = (F.col("partitions_nonempty") <= F.least("distinct_keys", F.lit(16))) & (F.col("max_rows") >= F.col("hottest_rows"))
    return both.select("key", "distinct_keys", "hottest_key", "hottest_rows", "median_rows", "skew_ratio", fits.alias("fits"))


@query("salt_column", "SELECT 0 AS least, 15 AS most, 16::BIGINT AS salts, count(*) AS n, true AS even FROM events")
def salt_column(spark, data):
    """Every salt is used, and the largest holds under twice an even share."""
    salted = skew.with_salt(inputs.skewed_events(spark, data), ["event_id", "user_id"], 16)
    per_salt = salted.groupBy(F.col("_salt").alias("salt")).agg(F.count("*").alias("n"))
    return per_salt.agg(
        F.min("salt").alias("least"), F.max("salt").alias("most"), F.count("*").alias("salts"), F.sum("n").alias("total"), (16 * F.max("n") < 2 * F.sum("n")).alias("even")
    ).withColumnRenamed("total", "n")


@query("explode_dim", inputs.outcomes_sql(", unnest(range(0, 4))::INT AS salt"))
def explode_dim(spark, data):
    dim = spark.read.parquet(inputs.outcomes(spark, data))
    return skew.explode_dim(dim, 4).withColumnRenamed("_salt", "salt")
