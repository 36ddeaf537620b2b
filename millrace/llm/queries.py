"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.centroids import clusters
from millrace.llm.chaining import shared_passages
from millrace.llm.chat import repair_roles
from millrace.llm.decontam import contaminated
from millrace.llm.encode import tokenizer_path
from millrace.llm.fertility import judged, with_features
from millrace.llm.lexical import ranked
from millrace.llm.licences import find_licences
from millrace.llm.near_vectors import near_vectors
from millrace.llm.ngram_join import ngram_components
from millrace.llm.packing import pack
from millrace.llm.prefix_counts import count_prefixes
from millrace.llm.registry import ORACLES, QUERIES, query, table
from millrace.llm.token_files import read_token_files, token_folder, write_token_files
from millrace.llm.wrappers import extract

__all__ = ["ORACLES", "QUERIES"]


@query("op1_decontamination")
def op1(spark: SparkSession, data: str) -> DataFrame:
    return contaminated(table(spark, data, "documents"), table(spark, data, "benchmark"))


_JACCARD_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
grams AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [w]
         ELSE list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2]) END) AS g
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n
  HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))),
reach(doc_id, other) AS (
  SELECT a, b FROM links
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(m.least, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
LEFT JOIN (SELECT doc_id, min(other) AS least FROM reach GROUP BY doc_id) m ON m.doc_id = d.doc_id
"""


@query("op2_ngram_jaccard", _JACCARD_SQL)
def op2(spark: SparkSession, data: str) -> DataFrame:
    return ngram_components(table(spark, data, "documents"), words_each=3, percent=90)


@query("op3_token_files")
def op3(spark: SparkSession, data: str) -> DataFrame:
    folder = token_folder(spark)
    files = write_token_files(table(spark, data, "documents"), folder, tokenizer_path("word_bpe_49k.json"), end_id=2)
    return read_token_files(spark, folder, files)


@query("op4_fertility")
def op4(spark: SparkSession, data: str) -> DataFrame:
    docs = table(spark, data, "documents").select("doc_id", "lang", "text")
    return judged(with_features(docs, tokenizer_path("piece_bpe_32k.model"), drop=("text",))).drop("lang")


@query("op5_prefix_counts")
def op5(spark: SparkSession, data: str) -> DataFrame:
    return count_prefixes(table(spark, data, "documents"), tokenizer_path("byte_bpe_50k.json"), budget=1024)


@query("op6_packing")
def op6(spark: SparkSession, data: str) -> DataFrame:
    return pack(table(spark, data, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=1, length=2048)


@query("op7_wrappers")
def op7(spark: SparkSession, data: str) -> DataFrame:
    return extract(table(spark, data, "pages"))


@query("op8_licences")
def op8(spark: SparkSession, data: str) -> DataFrame:
    return find_licences(table(spark, data, "documents"))


@query("op9_chat_roles")
def op9(spark: SparkSession, data: str) -> DataFrame:
    return repair_roles(table(spark, data, "conversations"))


@query("op10_chaining")
def op10(spark: SparkSession, data: str) -> DataFrame:
    return shared_passages(table(spark, data, "documents"))


def _clusters_sql(k: int = 16, rounds: int = 3) -> str:
    """Lloyd rounds as chained tables: c0, a0, c1, a1, ..."""

    def assigned(n: int) -> str:
        square = "list_sum(list_transform(list_zip(v.e, c.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::HUGEINT"
        return f"""a{n} AS (
  SELECT vec_id, e, best.c AS c, best.d AS d FROM (
    SELECT v.n, v.vec_id, any_value(v.e) AS e, min({{'d': {square}, 'c': c.c}}) AS best
    FROM v CROSS JOIN c{n} c GROUP BY v.n, v.vec_id))"""

    def moved(n: int) -> str:
        return f"""m{n} AS (
  SELECT c, list(x ORDER BY i) AS e FROM (
    SELECT c, i, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS x
    FROM (SELECT c, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM a{n - 1}) GROUP BY c, i) GROUP BY c),
c{n} AS (SELECT o.c, coalesce(m.e, o.e) AS e FROM c{n - 1} o LEFT JOIN m{n} m ON m.c = o.c)"""

    steps = ",\n".join(f"{moved(n)},\n{assigned(n)}" for n in range(1, rounds + 1))
    return f"""
WITH v AS (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS (
  SELECT (row_number() OVER (ORDER BY h, e) - 1)::INTEGER AS c, e
  FROM (SELECT sha256('1:' || vec_id) AS h, e FROM v ORDER BY h, e LIMIT {k})),
{assigned(0)},
{steps}
SELECT vec_id, a.c AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.c = a.c
"""


@query("op11_centroids", _clusters_sql())
def op11(spark: SparkSession, data: str) -> DataFrame:
    return clusters(table(spark, data, "embeddings"), k=16, rounds=3, dim=64, seed="1")


_NEAR_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach(vec_id, other) AS (
  SELECT a, b FROM links
  UNION
  SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(m.least, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(m.least, e.vec_id)) AS kept
FROM embeddings e
LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) n ON n.a = e.vec_id
LEFT JOIN (SELECT vec_id, min(other) AS least FROM reach GROUP BY vec_id) m ON m.vec_id = e.vec_id
"""


@query("op12_sign_hashing", _NEAR_SQL)
def op12(spark: SparkSession, data: str) -> DataFrame:
    return near_vectors(table(spark, data, "embeddings"), cosine=0.9)


_RANKED_SQL = r"""
WITH lowered AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
docs AS (SELECT doc_id, w, len(w) AS n FROM lowered WHERE len(w) > 0),
total AS (SELECT count(*) AS n, sum(n)::BIGINT AS l FROM docs),
queries AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
held AS (
  SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(w) AS term FROM docs)
  WHERE term IN (SELECT term FROM queries) GROUP BY doc_id, n, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * t.n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM held, total t GROUP BY term, t.n),
impacts AS (
  SELECT h.doc_id, h.term, x.w * ((1000000000 * h.tf) // (1000 * h.tf + 8 * (10 + (90 * h.n * t.n) // t.l))) AS s
  FROM held h JOIN weights x ON x.term = h.term CROSS JOIN total t),
scores AS (SELECT q.item_id, i.doc_id, sum(i.s)::BIGINT AS score FROM queries q JOIN impacts i ON i.term = q.term GROUP BY q.item_id, i.doc_id),
ranks AS (SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranks WHERE rank <= 10
"""


@query("op13_pair_maxscore", _RANKED_SQL)
def op13(spark: SparkSession, data: str) -> DataFrame:
    return ranked(table(spark, data, "documents"), table(spark, data, "benchmark"), k=10)
