"""Shards of the line index when a batch is far larger than all before it."""

from tidemark.llm import line_dedup


def test_a_large_batch_is_dealt_by_the_shards_that_it_needs(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "KEYS_PER_SHARD", 100)
    sift, largest = line_dedup._sift, []

    def watched(keys, filters, n_shards):
        largest.append(keys.groupBy(line_dedup._shard(n_shards).alias("shard")).count().agg({"count": "max"}).first()[0])
        return sift(keys, filters, n_shards)

    monkeypatch.setattr(line_dedup, "_sift", watched)
    text = lambda a, b: "\n".join(f"a line of its own, number {i}" for i in range(a, b))
    docs = spark.createDataFrame([(1, text(0, 20)), (2, text(10, 3000)), (3, text(2990, 3100))], "doc_id long, text string")
    index = line_dedup.LineIndex()
    for i in (1, 2, 3):
        index = line_dedup.insert(index, docs.filter(f"doc_id = {i}"))
    assert len(largest) == 2 and max(largest) <= 100
    assert index.counts.count() == 3100 and index.counts.filter("n_docs = 2").count() == 20
    got = {r.doc_id: (r.n_lines, r.n_dropped) for r in line_dedup.apply_index(index, docs).collect()}
    assert got == {1: (20, 0), 2: (2990, 10), 3: (110, 10)}
    index = line_dedup.delete(index, spark.createDataFrame([(2,)], "doc_id long"))
    assert {r.doc_id: r.n_dropped for r in line_dedup.apply_index(index, docs.filter("doc_id <> 2")).collect()} == {1: 0, 3: 0}
