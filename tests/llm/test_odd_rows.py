"""Null and repeated ids, null texts, clashing extra columns and empty tables: every case has the result that docstrings state."""

import random
from fractions import Fraction

import pytest

from tidemark.llm import language_id, quality, secret_scan
from tidemark.llm.decontaminate import decontaminate
from tidemark.llm.mixing import mix, source_targets
from tidemark.llm.substring_dedup import remove_repeats

pipeline = pytest.importorskip("corpus_pipeline")

EN, DE = "the cat sat on the mat with the other cats", "der hund und die katze sind nicht mit dem haus"
KEY = "password = hunter2hunter2"


def docs(spark, rows):
    """Rows of documents with extra columns whose names the operators use inside."""
    extra = "score double, spans string, n int, label string, h int, node long, kept string"
    return spark.createDataFrame([(*r, len(r[1] or ""), None, "x", 7, None, 1, None, "k") for r in rows], f"doc_id long, text string, lang string, source string, n_chars long, {extra}")


def sorted_rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


ROWS = [(1, EN, "en", "a"), (1, EN, "en", "a"), (2, DE, "de", None), (None, EN, None, "a"), (None, None, None, None), (3, None, "en", "b"), (4, "", None, "b"), (5, KEY, None, "b"), (5, KEY, None, "b"), (None, KEY, None, None)]


def test_decontamination_judges_every_row_by_itself(spark):
    items = spark.createDataFrame([("i", "cat sat on", 1), ("i", "cat sat on", 2), ("i", "dem haus", 3), (None, "hunter2hunter2", 4), ("j", None, 5), ("k", "...", 6)], "item_id string, text string, spans int")
    got = sorted_rows(decontaminate(docs(spark, ROWS), items), "doc_id", "n_words", "n_hit", "n_items", "contaminated")
    assert got == sorted([(1, 10, 3, 1, True)] * 2 + [(2, 10, 2, 1, True), (None, 10, 3, 1, True), (None, 0, 0, 0, False), (3, 0, 0, 0, False), (4, 0, 0, 0, False), (5, 2, 0, 0, False), (5, 2, 0, 0, False), (None, 2, 0, 0, False)], key=repr)
    assert decontaminate(docs(spark, ROWS).filter("doc_id < 0"), items).count() == 0
    assert decontaminate(docs(spark, ROWS), items.filter("spans < 0")).filter("n_hit > 0 or contaminated").count() == 0


def test_language_of_rows_without_id_and_of_repeats(spark):
    table = docs(spark, ROWS)
    model = language_id.fit(table)
    assert model.langs == ["de", "en"]
    got = sorted_rows(language_id.identify(table, model), "doc_id", "lang_pred")
    assert [p for i, p in got if i == 1] == ["en", "en"] and (2, "de") in got and (None, "en") in got
    assert [p for i, p in got if i in (3, 4)] == ["und", "und"] and (None, "und") in got and len(got) == len(ROWS)
    again = {(r.doc_id, r.score) for r in language_id.identify(table, model).filter("doc_id in (1, 5)").collect()}
    assert len(again) == 2
    assert language_id.identify(table.filter("doc_id < 0"), model).count() == 0
    # Nothing to learn from: every text is undetermined.
    nothing = language_id.fit(table.filter("lang is null"))
    assert {r.lang_pred for r in language_id.identify(table, nothing).collect()} == {"und"}


def test_mix_gives_each_repeated_row_its_own_share(spark):
    out = mix(docs(spark, ROWS), share=1.0).collect()
    assert len(out) == len(ROWS) and all(0 <= r.taken <= 2 * r.size for r in out)
    by_source = {}
    for r in out:
        by_source.setdefault((r.source, r.source_size, int(r.target)), []).append(r.taken)
    assert {k[0]: (k[1], sum(v) == k[2]) for k, v in by_source.items()} == {"a": (30, True), "b": (6, True), None: (13, True)}
    again = sorted_rows(mix(docs(spark, ROWS[::-1]).repartition(3), share=1.0), "doc_id", "source", "size", "taken")
    assert again == sorted_rows(mix(docs(spark, ROWS), share=1.0), "doc_id", "source", "size", "taken")


def reshared(sizes, weights, share, epochs):
    """Targets as they are defined: shares by weight, and what is above a cap is shared again among the others."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    cap, full = {s: epochs * sizes[s] for s in names}, set()
    total = Fraction(share) * sum(sizes.values())
    while open_ := [s for s in names if s not in full]:
        level = (total - sum(cap[s] for s in full)) / sum(weight[s] for s in open_)
        above = {s for s in open_ if level * weight[s] > cap[s]}
        if not above:
            return {s: float(cap[s] if s in full else level * weight[s]) for s in names}
        full |= above
    return {s: float(cap[s]) for s in names}


@pytest.mark.parametrize("share, epochs", [(1.5, 2), (1.0, 2), (0.25, 1), (2.0, 2), (3.0, 2)])
def test_targets_equal_resharing(spark, share, epochs):
    rng = random.Random(int(share * 8))
    cases = [{f"s{i}": 100 for i in range(20)}, {"a": 1000, "b": 10, None: 5}, {"a": 10, "b": 10, None: 5000}, {"a": 0, "b": 7}, {"a": 0}]
    cases += [{f"s{i}": rng.choice([0, 3, 50, 999, 10**6]) for i in range(rng.randint(1, 12))} for _ in range(3)]
    for sizes in cases:
        rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in source_targets(rows, share=share, max_epochs=epochs).collect()}
        want = reshared(sizes, (5, 2, 1), share, epochs)
        assert got == pytest.approx(want), sizes
        assert sum(got.values()) == pytest.approx(min(share, epochs) * sum(sizes.values()))


def test_substrings_of_repeated_and_missing_ids(spark):
    got = sorted_rows(remove_repeats(docs(spark, ROWS), length=20), "doc_id", "n_bytes", "n_removed", "n_spans")
    # Copies go whole wherever they have an id; rows without id stay, but others are judged against them.
    assert got == sorted([(1, len(EN), len(EN), 1)] * 2 + [(2, len(DE), 0, 0), (None, len(EN), 0, 0), (None, 0, 0, 0), (3, 0, 0, 0), (4, 0, 0, 0)] + [(5, len(KEY), len(KEY), 1)] * 2 + [(None, len(KEY), 0, 0)], key=repr)
    alone = [(1, EN, "en", "a"), (None, EN, "en", "a")]
    assert sorted_rows(remove_repeats(docs(spark, alone), length=20), "doc_id", "n_removed") == sorted([(1, len(EN)), (None, 0)], key=repr)


def test_secrets_of_repeated_and_missing_ids(spark):
    out = secret_scan.scan(docs(spark, ROWS))
    got = sorted((r.doc_id is None, r.doc_id or 0, secret_scan.KINDS[s.kind], s.start, s.stop) for r in out.collect() for s in r.spans)
    assert got == [(False, 5, "assign", 0, len(KEY))] * 2 + [(True, 0, "assign", 0, len(KEY))]
    assert out.count() == len(ROWS)


def test_quality_of_repeated_rows_and_missing_labels(spark):
    labels = {1: 1, 2: 0, 3: 0, 4: None, 5: 7}
    table = docs(spark, ROWS)
    labelled = spark.createDataFrame([(*r, labels.get(r[0])) for r in ROWS], "doc_id long, text string, lang string, source string, quality int")
    model = quality.fit(labelled)
    out = quality.score(table, model).collect()
    assert len(out) == len(ROWS) and all(0 <= r.score <= 1 for r in out)
    score = {}
    for r in out:
        score.setdefault(r.doc_id, set()).add(r.score)
    assert len(score[1]) == len(score[5]) == 1 and min(score[1]) > max(score[2]) and score[3] == score[4]
    assert quality.score(table.filter("doc_id < 0"), model).count() == 0


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd"))
    spark.createDataFrame([("i", "cat sat on")], "item_id string, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_on_odd_rows(spark, folder):
    table = docs(spark, ROWS)
    stages = dict(pipeline.STAGES)
    plain = table.select(*pipeline.COLUMNS)
    kept = lambda name: sorted_rows(stages[name](spark, table, folder), "doc_id", "text")
    every = sorted_rows(table, "doc_id", "text")
    # Texts without a language go; repeated rows and rows without id are judged by their text.
    got = kept("language_id")
    assert not [r for r in got if not r[1]] and got.count((1, EN)) == 2 and (2, DE) in got and (None, EN) in got
    # Lines of a smaller id go from larger ones; rows without id stay as they are.
    lines = kept("line_dedup")
    assert len(lines) == len(every) and lines.count((1, EN)) == 2 and (None, EN) in lines and (2, DE) in lines
    # Rows of one id stay or go together; rows without id stay.
    near = kept("near_dedup")
    assert near == every
    clean = kept("decontamination")
    assert clean == [r for r in every if r[1] != EN]
    mixed = stages["mixing"](spark, table, folder)
    assert mixed.count() == len(every)
    for name, stage in pipeline.STAGES[:-1]:
        assert stage(spark, table, folder).columns == plain.columns


@pytest.mark.parametrize("name", [n for n, _ in pipeline.STAGES])
def test_stages_on_an_empty_table(spark, folder, name):
    assert dict(pipeline.STAGES)[name](spark, docs(spark, ROWS).filter("doc_id < 0"), folder).count() == 0
