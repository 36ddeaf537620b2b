"""Queries on projections, filters, flags, dedup, order and set operations."""

from pyspark.sql import functions as F

from millrace.functions.columns import not_blank
from millrace.operators import aggregates as agg
from millrace.operators import facts, joins
from millrace.operators.ranking import numbered, top_k
from millrace.operators.text import word_count
from millrace.plans import inputs
from millrace.plans.registry import query, table
from millrace.session import shared_path
from millrace.sources.layout import spread, write_files

TOKENS_SQL = """
SELECT w AS word, count(*) AS n
FROM (SELECT regexp_replace(unnest(regexp_split_to_array(lower(text), '\\s+')),
                            '^[.,;:!?"''()]+|[.,;:!?"''()]+$', '', 'g') AS w FROM documents)
WHERE w <> '' GROUP BY w
"""


@query("project_named", "SELECT doc_id, lang, n_chars FROM documents")
def project_named(spark, data):
    return table(spark, data, "documents").select("doc_id", "lang", "n_chars")


@query("project_existing", "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders")
def project_existing(spark, data):
    return facts.keep_existing(table(spark, data, "orders"), ["o_orderkey", "o_custkey", "o_shipmode", "o_orderpriority"])


@query("filter_compare", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity >= 40")
def filter_compare(spark, data):
    return table(spark, data, "lineitem").where(F.col("l_quantity") >= 40).select("l_orderkey", "l_linenumber", "l_quantity")


@query("filter_not_blank", "SELECT doc_id, n_chars FROM documents WHERE text IS NOT NULL AND trim(text) <> ''")
def filter_not_blank(spark, data):
    return table(spark, data, "documents").where(not_blank("text")).select("doc_id", "n_chars")


@query("filter_terminal_rows", "SELECT event_id, event_type AS k FROM events WHERE event_id % 4 = 0")
def filter_terminal_rows(spark, data):
    return inputs.skewed_events(spark, data).where(F.col("k").isNotNull()).select("event_id", "k")


@query("flag_regex", "SELECT event_id, regexp_matches(event_type, 'error|signup') AS is_out FROM events")
def flag_regex(spark, data):
    return table(spark, data, "events").select("event_id", F.col("event_type").rlike("error|signup").alias("is_out"))


@query("flag_in_list", "SELECT event_id, event_type IN ('purchase', 'view') AS is_hit FROM events")
def flag_in_list(spark, data):
    return table(spark, data, "events").select("event_id", F.col("event_type").isin("purchase", "view").alias("is_hit"))


@query(
    "classify_default",
    """
SELECT event_type, CASE event_type WHEN 'click' THEN 'Click' WHEN 'view' THEN 'Page view'
                   ELSE 'Unclassified (' || event_type || ')' END AS label,
       CASE WHEN event_type IN ('click', 'view') THEN 'browse' ELSE 'other' END AS family
FROM (SELECT DISTINCT event_type FROM events)
""",
)
def classify_default(spark, data):
    codes = facts.distinct_values(table(spark, data, "events"), "event_type")
    labels = [("click", "Click", "browse"), ("view", "Page view", "browse")]
    return facts.classify(codes, "event_type", labels, "label", "family")


@query(
    "dedup_keys",
    """
SELECT * EXCLUDE (rn, l_shipdate), strftime(l_shipdate, '%Y-%m-%d') AS ship_date FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity,
         l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS rn FROM lineitem)
WHERE rn = 1
""",
)
def dedup_keys(spark, data):
    return inputs.with_ship_date(facts.dedup(table(spark, data, "lineitem"), ["l_orderkey", "l_linenumber"]))


_ENDED_SQL = """
SELECT l_orderkey, l_linenumber, outcome, l_suppkey, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY outcome, l_suppkey, l_quantity) AS rn
  FROM (SELECT l_orderkey, l_linenumber, nullif(l_returnflag, 'N') AS outcome, l_suppkey, l_quantity FROM lineitem) WHERE outcome IS NOT NULL)
WHERE rn = 1
"""


def _ended(spark, data):
    """Line items with an outcome stand in for the last pitches of plate appearances."""
    li = table(spark, data, "lineitem").withColumn("outcome", F.nullif("l_returnflag", F.lit("N")))
    wanted = ["l_orderkey", "l_linenumber", "outcome", "l_shipmode", "l_suppkey", "l_quantity"]
    return li, facts.terminal_rows(li, "outcome", ["l_orderkey", "l_linenumber"], wanted, ["l_suppkey"])


@query("fact_terminal", _ENDED_SQL)
def fact_terminal(spark, data):
    return _ended(spark, data)[1]


@query(
    "fact_terminal_ratio",
    f"""
SELECT a.n AS n_a, b.n AS n_b, round(a.n / b.n, 1) AS ratio, a.n / b.n < 3 AS low
FROM (SELECT count(*) AS n FROM lineitem) a, (SELECT count(*) AS n FROM ({_ENDED_SQL})) b
""",
)
def fact_terminal_ratio(spark, data):
    """The derived fact written as files, then compared in size with the one it comes from."""
    li, ended = _ended(spark, data)
    path = shared_path(spark, "fact_terminal")
    write_files(ended, path, 8)
    return agg.table_ratio(li, spark.read.parquet(path))


@query("distinct_values", "SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL")
def distinct_values(spark, data):
    return facts.distinct_values(table(spark, data, "part"), "p_brand")


@query(
    "derive_dates",
    """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS game_date, month(o_orderdate)::INT AS game_month FROM orders
""",
)
def derive_dates(spark, data):
    dated = facts.with_dates(table(spark, data, "orders"), "o_orderdate")
    return dated.select("o_orderkey", F.date_format("game_date", "yyyy-MM-dd").alias("game_date"), "game_month")


@query("filter_udf", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity >= 40")
def filter_udf(spark, data):
    li = table(spark, data, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return facts.udf_filter(li, "l_quantity", 40.0)


@query(
    "sort_desc",
    """
SELECT l_partkey, n, row_number() OVER (ORDER BY n DESC, l_partkey) AS pos
FROM (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey)
""",
)
def sort_desc(spark, data):
    counts = table(spark, data, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n"))
    placed = numbered(counts, [F.desc("n"), F.col("l_partkey")])
    return placed.withColumn("pos", F.col("pos") + 1)


@query(
    "sort_swap_top10",
    f"SELECT n, word, row_number() OVER (ORDER BY n DESC, word) AS pos FROM ({TOKENS_SQL}) ORDER BY n DESC, word LIMIT 10",
)
def sort_swap_top10(spark, data):
    swapped = word_count(spread(table(spark, data, "documents")), "text").select("n", "word")
    return top_k(swapped, 10, [F.desc("n"), F.col("word")])


@query(
    "topk_by_pair",
    """
SELECT l_partkey, n, avg_price, row_number() OVER (ORDER BY n DESC, l_partkey) AS pos FROM (
  SELECT l_partkey, count(*) AS n, round(sum(l_extendedprice) / count(*), 4) AS avg_price FROM lineitem GROUP BY l_partkey)
ORDER BY n DESC, l_partkey LIMIT 10
""",
)
def topk_by_pair(spark, data):
    pairs = agg.fast_pairs(table(spark, data, "lineitem"), "l_partkey", "l_quantity", "l_extendedprice", 0.0)
    top = top_k(pairs, 10, [F.desc("n"), F.col("l_partkey")])
    return top.select("l_partkey", "n", F.round("avg_spin", 4).alias("avg_price"), "pos")


@query(
    "union_replicate",
    "SELECT user_id, count(*) * 80 AS n FROM events GROUP BY user_id",
)
def union_replicate(spark, data):
    copies = agg.replicate(table(spark, data, "events").select("user_id"), 80)
    return copies.groupBy("user_id").agg(F.count("*").alias("n"))


@query(
    "union_all",
    "SELECT 'customer' AS kind, c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier",
)
def union_all(spark, data):
    c = table(spark, data, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    s = table(spark, data, "supplier").select(F.col("s_name").alias("name"), F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"))
    return c.unionByName(s)


@query(
    "except_all",
    """
SELECT l_suppkey, l_quantity, 'left' AS side FROM (SELECT l_suppkey, l_quantity FROM lineitem WHERE l_returnflag <> 'A' EXCEPT ALL
  SELECT l_suppkey, l_quantity FROM lineitem WHERE l_linestatus = 'F')
UNION ALL
SELECT l_suppkey, l_quantity, 'right' FROM (SELECT l_suppkey, l_quantity FROM lineitem WHERE l_linestatus = 'F' EXCEPT ALL
  SELECT l_suppkey, l_quantity FROM lineitem WHERE l_returnflag <> 'A')
""",
)
def except_all(spark, data):
    li = table(spark, data, "lineitem")
    a = li.where("l_returnflag <> 'A'").select("l_suppkey", "l_quantity")
    b = li.where("l_linestatus = 'F'").select("l_suppkey", "l_quantity")
    return joins.difference(a, b)
