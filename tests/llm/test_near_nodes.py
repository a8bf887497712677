"""Near-duplicates whose common nodes are all too large to be compared at once."""

from pyspark.sql import functions as F

from tidemark.llm import near_dedup


def test_a_link_is_found_whichever_large_nodes_the_pair_has_in_common(spark, monkeypatch):
    """Two sets of similarity 0.8 share 7 nodes of the first level, but none of the six first by hash of each; other
    documents that hold parts of them make every node large, and are the pivots."""
    monkeypatch.setattr(near_dedup, "LEAF", 2)
    words = [f"w692x{i}" for i in range(100)]
    parts = [words[25 * k : 25 * k + 25] for k in range(4)] + [words[k::4] for k in range(4)]
    ranked = spark.range(200).select(F.col("id").alias("doc_id")).select("doc_id", near_dedup._order(0).alias("x"), near_dedup._order(1).alias("y")).collect()
    ids = [r.doc_id for r in sorted(ranked, key=lambda r: max(r.x, r.y))][:8]
    pair = [r.doc_id for r in sorted(ranked, key=lambda r: min(r.x, r.y))][-2:]
    texts = dict(zip([*ids, *pair], [" ".join(p) for p in [*parts, words[:80], words]], strict=True))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs, shingle=1, similarity=80).collect()}
    assert got == {i: i for i in ids} | {i: min(pair) for i in pair}
