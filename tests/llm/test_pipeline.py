"""The pipeline's stages, one after the other, against brute force on a small table."""

import corpus_pipeline
from millrace.llm.chaining import shared_passages
from millrace.llm.decontam import contaminated
from millrace.llm.encode import tokenizer_path
from millrace.llm.fertility import judged, with_features
from millrace.llm.ngram_join import ngram_components
from millrace.session import SHUFFLES_GO, shared_path, stored
from millrace.sources.storage import names
from tests.llm.edge_rows import edge_docs, no_docs


def test_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = spark.createDataFrame(stage(spark, docs, data).collect(), docs.schema)
        assert after.columns == columns
        gone = {r.doc_id for r in docs.collect()} - {r.doc_id for r in after.collect()}
        if name == "quality rules":
            rows = judged(with_features(docs, tokenizer_path("piece_bpe_32k.model"))).collect()
            assert gone == {r.doc_id for r in rows if not r.kept}
        elif name == "n-gram Jaccard join":
            assert gone == {r.doc_id for r in ngram_components(docs).collect() if r.doc_id != r.component_id}
        elif name == "substring dedup":
            changed = {r.doc_id: r.text for r in docs.collect()}
            assert {r.doc_id for r in after.collect() if changed[r.doc_id] != r.text} | gone == {r.doc_id for r in shared_passages(docs).collect()}
        else:
            assert gone == {r.doc_id for r in contaminated(docs, spark.read.parquet(f"{data}/benchmark.parquet")).collect()}
        docs = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, data).collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in docs.collect()}


def test_edge_rows_pass_every_stage(spark, data):
    for docs in (edge_docs(spark), no_docs(spark)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, data)
            assert after.columns == docs.columns
            assert after.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, data).count() >= docs.count()


def test_tables_on_the_way_go_once_the_result_is_stored(spark, data):
    """What a stage stored for itself only does not lie on the disk while the next ones run."""
    folder = shared_path(spark, "x").rpartition("/")[0]
    docs = spark.read.parquet(f"{data}/documents.parquet")
    for name, kept in (("n-gram Jaccard join", "gone"), ("substring dedup", "spans")):
        before = set(names(spark, folder))
        after = dict(corpus_pipeline.STAGES)[name](spark, docs, data)
        assert after.count() <= docs.count()
        assert [n.rpartition("-")[0] for n in set(names(spark, folder)) - before] == [kept]


def test_shuffles_go_once_a_table_is_stored(spark):
    wide = spark.range(1000).repartition(3, "id")
    before = spark.conf.get(SHUFFLES_GO)
    again = stored(wide)
    assert spark.conf.get(SHUFFLES_GO) == before
    assert sorted(r.id for r in again.collect()) == list(range(1000)) and wide.count() == 1000
