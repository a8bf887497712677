"""The bucketed upsert: work follows the batch, repeated and failed batches, late rows; and the stream over it."""

import datetime as dt

import pytest

from tidemark.features.facts import metric_vintages
from tidemark.sources.lake import upsert
from tidemark.streaming import streams as ST

SCHEMA = "k int, v string, t int"


def table(spark, root):
    return sorted(tuple(r) for r in ST.read_buckets(spark, root).select("k", "v", "t").collect())


def files(root):
    return {str(p.relative_to(root)) for p in root.rglob("*.parquet")}


def test_only_touched_buckets_are_written(spark, tmp_path):
    root, put = str(tmp_path), lambda rows, i, **kw: ST.bucketed_upsert(str(tmp_path), spark.createDataFrame(rows, SCHEMA), i, ["k"], ["t"], n_buckets=16, **kw)
    assert ST.read_buckets(spark, root) is None
    first = [(k, "a", 1) for k in range(200)] + [(None, "n", 1)]
    assert put(first, 0) == list(range(16))
    before = files(tmp_path)
    assert len(put([(7, "b", 2), (7, "c", 3), (7, "late", 0)], 1)) == 1
    new = files(tmp_path) - before
    assert len(new) == 2 and {n.split("/")[0] for n in new} == {"data", "manifest"}
    want = sorted([(k, "a", 1) for k in range(200) if k != 7] + [(7, "c", 3)])
    assert [r for r in table_known(spark, root)] == want
    now = files(tmp_path)
    assert put([(7, "again", 9)], 1) == [] and put(first, 0) == [] and put([], 2) == [] and files(tmp_path) == now
    assert len(put([(None, "m", 2)], 0, writer="other")) == 1 and table_known(spark, root) == want
    assert [r.v for r in ST.read_buckets(spark, root).filter("k is null").collect()] == ["m"]
    with pytest.raises(ValueError):
        ST.bucketed_upsert(root, spark.createDataFrame(first, SCHEMA), 5, ["k"], ["t"], n_buckets=4)


def table_known(spark, root):
    return sorted(tuple(r) for r in ST.read_buckets(spark, root).filter("k is not null").select("k", "v", "t").collect())


def test_a_failure_before_the_swap_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    put = lambda rows, i: ST.bucketed_upsert(root, spark.createDataFrame(rows, SCHEMA), i, ["k"], ["t"], n_buckets=4)
    put([(1, "a", 1), (2, "a", 1)], 0)
    with monkeypatch.context() as m:
        def lost(*_):
            raise RuntimeError("lost")

        m.setattr(ST, "_swap", lost)
        with pytest.raises(RuntimeError):
            put([(1, "b", 2), (3, "b", 2)], 1)
    assert table(spark, root) == [(1, "a", 1), (2, "a", 1)]
    put([(1, "b", 2), (3, "b", 2)], 1)
    assert table(spark, root) == [(1, "b", 2), (2, "a", 1), (3, "b", 2)]


def test_stream_equals_batch_upsert_and_goes_on_from_its_checkpoint(spark, tmp_path):
    source, root, marks = str(tmp_path / "in"), str(tmp_path / "table"), str(tmp_path / "marks")
    parts = [[(k, f"{i}-{k}", (k * 7 + i) % 5) for k in range(i, 40 + i)] for i in range(3)]
    seen = []
    for part in parts:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        seen += part
        ST.stream_upsert(ST.read_files(spark, source, spark.createDataFrame([], SCHEMA).schema, 1), root, ["k"], ["t", "v"], marks, n_buckets=4).awaitTermination()
        df = spark.createDataFrame(seen, SCHEMA)
        want = upsert(df.limit(0), df, ["k"], [df.t, df.v])
        assert table(spark, root) == sorted(tuple(r) for r in want.select("k", "v", "t").collect())


def test_numbered_vintages_equal_batch_numbering(spark, tmp_path):
    """Files with repeated, out-of-order and too late rows, beside D22 over those that weren't too late."""
    at = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    parts = [
        [("a", 1, at(10), 5.0), ("a", 2, at(4), 4.0), ("b", 3, at(9), None), ("a", 1, at(10), 5.0)],
        [("a", 4, at(7), 4.0), ("b", 5, at(30), None), ("a", 1, at(10), 5.0), ("c", 6, None, 1.0)],  # the watermark goes to hour 20
        [("a", 7, at(15), 9.0), ("a", 8, at(25), 5.0), ("b", 9, at(29), 2.0), ("a", 4, at(7), 4.0)],  # 7 and 4 come too late
        [("z", 10, at(90), 0.0)],
        [("z", 11, at(200), 0.0)],
    ]
    schema = "k string, receipt long, at timestamp, v double"
    kind = spark.createDataFrame([], schema).schema
    for i, part in enumerate(parts):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = ST.read_files(spark, str(tmp_path / "in"), kind, 1)
        out = ST.stream_numbered_vintages(stream, ["k"], receipt="receipt", value="v", event_time="at", delay="10 hours")
        out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "marks")).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    got = spark.read.schema(out.schema).parquet(str(tmp_path / "out"))
    known = spark.createDataFrame([r for i, p in enumerate(parts) for r in p if r[2] and r[1] not in (7, 11) and not (i == 2 and r[1] == 4)], schema)
    want = metric_vintages(known, known.selectExpr("to_date(at) AS date"), keys=["k"], disclosed="at", receipt="receipt", value="v")
    cols = ["k", "receipt", "v", "at", "vintage", "lineage", "changed"]
    rows = lambda df: sorted(map(str, (tuple(r) for r in df.select(*cols).collect())))
    assert rows(got) == rows(want)
    assert {r.receipt: r.supersedes for r in got.collect()} == {2: None, 4: 1, 1: 2, 8: 3, 3: None, 9: 1, 5: 2, 10: None}
