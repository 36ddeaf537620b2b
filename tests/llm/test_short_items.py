"""Benchmark items that are very short, or that come very often."""

from millrace.llm.decontam import contaminated, drop_contaminated, item_blocks, item_rows
from tests.llm.edge_rows import prose


def test_short_and_frequent_items(spark):
    items = [(1, "Blue whale?"), (2, "xyzzy"), (3, "  ")] + [(10 + i, "the very same benchmark question each time") for i in range(200)]
    items = spark.createDataFrame(items, "item_id long, text string")
    end = prose(8, 20)
    docs = [(1, end + " a blue whale, " + end), (2, end + " a blue whales " + end), (3, "xyzzy"), (4, "xyzzyx axyzzy"), (5, "THE very same benchmark question each time"), (6, "")]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in contaminated(docs, items).collect()}
    assert found == {(1, 1), (3, 2)} | {(5, 10 + i) for i in range(200)}
    assert {r.doc_id for r in drop_contaminated(docs, items).collect()} == {2, 4, 6}
    blocks = list(item_blocks(item_rows(items), 100))
    assert sum(map(len, blocks)) == 4 and all(sum(len(t) for _, t in b) <= 200 for b in blocks)
