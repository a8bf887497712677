"""Packing, centroid clustering and spelling variants against brute force: nulls, empty and long texts, ties, repeats, clashing names."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import centroids, packing, spelling

DOCS = "doc_id long, text string, part int, ids string, n string, word string, pos int"


def documents(spark, texts, ids=None, parts=3):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, 7, "x", "y", "z", 1) for i, t in zip(ids, texts, strict=True)], DOCS).repartition(parts)


# 13 packing


def library_ids(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    library_ids.t = getattr(library_ids, "t", None) or Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return library_ids.t.encode(text or "", add_special_tokens=False).ids + [1]


TEXTS = [None, "", " ", "one", "a<|endoftext|>b <|startoftext|>", "İstanbul ΣΑΣ ẞ 中文 é 's''s 12345 \x00", "aaaaaaaa bbbbbbb " * 30, "long words and more " * 900, "x" * 5000, "!?" * 700]


def check_packing(spark, docs, length):
    want = Counter()
    texts = defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        want[r.doc_id, tuple(library_ids(r.text))] += 1
        texts[r.doc_id].append(library_ids(r.text))
    out = packing.pack(docs, "word_bpe_49k.json", length=length, keep_ids=True)
    rows = sorted(out.collect(), key=lambda r: (r.sequence_id, r.offset))
    stream = np.concatenate([np.frombuffer(r.ids, "<u4") for r in rows]) if rows else np.array([], int)
    assert len(stream) == sum(len(ids) * n for (_, ids), n in want.items())
    upto, got, at = 0, Counter(), 0
    for r in rows:
        assert (r.sequence_id, r.offset) == divmod(upto, length) and 0 < r.length <= length - r.offset and r.length * 4 == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(bytes(r.ids))
        if r.start == 0:
            at = upto
        assert r.start == upto - at
        upto += r.length
        if r.start + r.length == r.doc_tokens:
            got[r.doc_id, tuple(stream[at:upto].tolist())] += 1
    assert got == want
    windows = {r.sequence_id: np.frombuffer(r.ids, "<u4").tolist() for r in packing.sequences(out, length).collect()}
    assert windows == {k: stream[k * length : (k + 1) * length].tolist() for k in range(-(-len(stream) // length))}


@pytest.mark.parametrize("length", [16, 2048])
def test_packing(spark, length):
    check_packing(spark, documents(spark, TEXTS), length)


def test_packing_repeated_and_null_ids_and_empty_partitions(spark):
    check_packing(spark, documents(spark, ["one two", "one two", "three", None], [1, 1, None, None], parts=9), 4)


def test_packing_nothing(spark):
    docs = documents(spark, ["a"])
    for none in (docs.limit(0), docs.filter("length(text) > 5")):
        assert packing.pack(none, "word_bpe_49k.json").count() == 0
        assert packing.sequences(packing.pack(none, "word_bpe_49k.json", keep_ids=True)).count() == 0


def test_packing_refuses_an_end_beyond_the_vocabulary():
    assert packing.encoder("word_bpe_49k.json").kind.itemsize == 2


def test_encoder_forgets_and_splits_special_strings(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 3)
    e = packing.encoder("word_bpe_49k.json")
    for t in [x or "" for x in TEXTS] * 2:
        assert np.frombuffer(e.encode_texts([t], b"\x01\x00")[0], e.kind).tolist() == library_ids(t)


# 11 centroid clustering

VECTORS = "vec_id long, embedding array<float>, q string, lo int, cluster string, place int"


def vectors(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, "q", 1, "c", 2) for i, v in rows], VECTORS).repartition(parts)


def brute_clusters(rows, k, rounds, dims, scale):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and np.isfinite(np.float32(x)) for x in v):
            kept.append((i, tuple(int(np.floor(float(np.float32(x)) * scale)) for x in v)))
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centers = [list(q) for _, q in first[:k]]

    def near(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c, strict=True)), n) for n, c in enumerate(centers))

    for _ in range(rounds):
        of = defaultdict(list)
        for _, q in kept:
            of[near(q)[1]].append(q)
        for n, qs in of.items():
            centers[n] = [sum(c) // len(qs) for c in zip(*qs, strict=True)]
    out = [(i, *near(q)[::-1]) for i, q in kept]
    own = Counter()
    for _, n, d in out:
        own[n] += d
    return Counter((i, n, d, own[n], sum(own.values()), hashlib.sha256(",".join(map(str, centers[n])).encode()).hexdigest()) for i, n, d in out)


def check_clusters(spark, rows, dims, k=16, scale=64, **options):
    out = centroids.cluster(vectors(spark, rows, **options), dims=dims, k=k, scale=scale)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert Counter(map(tuple, out.collect())) == brute_clusters(rows, k, 3, dims, scale)


def test_clusters(spark, monkeypatch):
    monkeypatch.setattr(centroids, "BLOCK", 16)
    rng = np.random.default_rng(4)
    means = rng.normal(size=(7, 8))
    rows = [(i, (means[i % 7] + 0.1 * rng.normal(size=8)).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[3][1]) for i in range(150)] + [rows[5]] * 3  # one common vector, repeated rows
    rows += [(2000, None), (2001, []), (2002, [1.0] * 7), (2003, [None] * 8), (2004, [float("nan")] * 8), (2005, [float("inf")] * 8), (None, rows[9][1]), (None, rows[9][1])]
    check_clusters(spark, rows, 8)
    check_clusters(spark, rows, 8, k=3, parts=12)


def test_clusters_of_ties_and_few_vectors(spark):
    grid = [(i, [float(i % 2), float(i // 2 % 2)]) for i in range(12)]
    check_clusters(spark, grid, 2, k=5)
    check_clusters(spark, grid[:2], 2, k=5)
    check_clusters(spark, [(1, [-0.01, 0.01])] * 4, 2)


def test_clusters_beyond_exact_doubles(spark):
    rows = [(i, [1e5 * i * (-1) ** i, 2e6 - 1e5 * i]) for i in range(20)]
    check_clusters(spark, rows, 2, k=4)


def test_components_that_are_too_far_are_an_error(spark):
    with pytest.raises(Exception, match="fit a long"):
        centroids.cluster(vectors(spark, [(1, [1e30, 0.0])]), dims=2).collect()


def test_clusters_of_nothing(spark):
    some = vectors(spark, [(1, [1.0, 2.0])])
    for none in (some.limit(0), some.filter("vec_id > 5"), some):
        assert centroids.cluster(none, dims=3).count() == 0


def test_curve_visits_neighbours_and_boxes_rule_out_centroids():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    order = np.argsort(centroids.hilbert(cells, 3))
    assert (np.abs(np.diff(cells[order], axis=0)).sum(1) == 1).all()
    rng = np.random.default_rng(1)
    centers, seen = rng.integers(-50, 50, (16, 12)), []
    for axes in (12, 5):
        frame = centroids.Frame(rng.normal(size=12), np.linalg.qr(rng.normal(size=(12, 12)))[0][:, :axes])
        for _ in range(200):
            x = rng.integers(-50, 50, 12) + rng.integers(0, 1 + rng.integers(0, 30), (30, 12))
            along, rest = frame.coordinates(x)
            among = centroids.candidates(along.min(0), along.max(0), rest.max(), centers, frame)
            seen.append(len(among))
            full = ((x[:, None] - centers) ** 2).sum(2)
            assert (among[centroids.nearest(x, centers[among])[0]] == full.argmin(1)).all()
    assert min(seen) == 1 and np.mean(seen[:200]) < 12
    same = np.repeat(centers[:1], 3, 0)  # equal centroids all stay, and the first wins
    assert centroids.candidates(along.min(0), along.max(0), rest.max(), same, frame).tolist() == [0, 1, 2]


# 12 spelling variants


def brute_vocabulary(rows, drop_every=None, min_length=6, min_count=5):
    out = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if drop_every and h % drop_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= min_length and n >= min_count}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(words, ratio=5):
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, words[w], len(near[w]), form[w], words.get(form[w]), root))
    return out


def check_variants(spark, words, parts=3):
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(parts)
    got = [tuple(r) for r in spelling.spelling_variants(df).collect()]
    assert len(got) == len(words) and set(got) == brute_variants(words)


def test_variants_of_dense_and_chained_words(spark):
    rng = random.Random(2)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 6))): rng.choice([5, 5, 25, 125, 700]) for _ in range(260)}
    words |= {"a" * k: 5**k for k in range(1, 9)}
    check_variants(spark, words)


def test_variants_of_long_words_and_common_prefixes(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HOT_NODES", 4)
    monkeypatch.setattr(spelling, "HOT_STATES", 2)
    rng = random.Random(5)
    base = ["inter" + "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(120)] + ["x" * 3000, "x" * 3001, "x" * 1500 + "y" + "x" * 1499, "ÿ" * 6]
    words = {}
    for w in base:
        words[w] = rng.choice([5, 30, 200])
        for _ in range(2):
            at = rng.randrange(len(w))
            words[rng.choice([w[:at] + w[at + 1 :], w[:at] + "z" + w[at:], w[:at] + "q" + w[at + 1 :]])] = rng.choice([5, 6, 25])
    check_variants(spark, words, parts=7)


def test_variants_of_few_words(spark):
    check_variants(spark, {"single": 9})
    df = spark.createDataFrame([("single", 9)], "word string, n long")
    assert spelling.spelling_variants(df.limit(0)).count() == 0
    assert spelling.spelling_variants(df.filter("n > 10")).count() == 0


@pytest.mark.parametrize("drop_every", [None, 3, 199])
def test_vocabulary(spark, monkeypatch, drop_every):
    monkeypatch.setattr(spelling, "HELD_WORDS", 20)
    rng = random.Random(7)
    pool = ["Garden", "GARDEN", "Été", "ÉTÉgarden", "naïvely", "planet", "plane", "abc1defghij", "w" * 4000, "ЖУК", "x", "housesŠhouses"]
    rows = [(i, " ".join(rng.choice(pool) for _ in range(30))) for i in range(40)] + [(50, None), (51, ""), (None, "planets " * 8), (7, "planets " * 8), (7, "planets " * 8)]
    docs = documents(spark, [t for _, t in rows], [i for i, _ in rows], parts=50)
    got = {r.word: r.n for r in spelling.vocabulary(docs, drop_every=drop_every).collect()}
    assert got == brute_vocabulary(rows, drop_every)
    assert spelling.vocabulary(docs.filter(F.length("text") > 10**9)).count() == 0
