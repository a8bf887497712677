"""Near-duplicates by a chosen-path set similarity join.

Texts become sets of hashed word shingles. Equal sets collapse to one representative. In each of several independent
trees, a representative goes to one node for each of its tokens whose hash lies under branching / set size: pairs of
similar sets choose a shared token with a probability that depends on their similarity alone. Every node first links
its members to one pivot (a number of pairs linear in its size), links are confirmed on the full sets, and nodes whose
members are connected by then are done, which settles large groups of copies. The other nodes are compared
exhaustively if they are small or nearly connected, and branch again by further tokens if not, with all their members;
what doesn't shrink is compared in blocks. What a step has superseded is deleted.
A pair at the similarity limit shares a root's child in no tree with probability exp(-branching * similarity * trees).
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Tables, few_broadcast, id_text, mix64, slices, utf8_columns
from tidemark.llm.components import components

#: Trees, and children that a set goes to from a root and from a deeper node.
TREES, BRANCHING, DEEPER = 6, 2.5, 1.5
#: Rounds in which open nodes link their members to a pivot.
STAR_ROUNDS = 2
#: Nodes up to LEAF members are compared exhaustively; larger ones at MAX_DEPTH in blocks of BLOCK.
LEAF, BLOCK, MAX_DEPTH = 1024, 2048, 3
#: Nodes up to so many members are compared exhaustively too, if but few of them differ in color from the rest.
WIDEST = 8 * LEAF
#: Smallest hashes kept of each set; pairs with less than this share of them in common aren't looked at in full.
SKETCH, SKETCH_SHARE = 32, 0.4
#: The same for leaves: sets up to this size are kept whole, so that their similarity is known there.
WIDE, WIDE_SHARE = 64, 0.53
#: A leaf with more likely pairs than this for each member is compared on full sets instead of passing the pairs on.
DENSE = 4
#: Pairs of one document that are confirmed in one group.
GROUP = 512
#: Rows of a group's matrix of intersections that are worked on at once.
ROWS = 256
#: Ids that are broadcast at most (8 bytes each); more of them are joined by shuffling.
BROADCAST_IDS = 1_000_000
CACHE_WORDS = 100_000

_STEP = np.uint64(0x9E3779B97F4A7C15)


class Shingler:
    """Sorted distinct 64-bit hashes of a text's word shingles; words are `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.cache: dict[bytes, int] = {}

    def _code(self, word: bytes) -> int:
        if len(self.cache) >= CACHE_WORDS:
            self.cache.clear()
        self.cache[word] = code = xxhash.xxh3_64_intdigest(word)
        return code

    def __call__(self, text: bytes | None) -> np.ndarray:
        words = (text or b"").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        get = self.cache.get
        codes = np.array([get(w) or self._code(w) for w in words], np.uint64)
        size = min(self.size, len(words))
        n = len(words) - size + 1
        out = np.full(n, size, np.uint64)
        for k in range(size):
            out = mix64(out * _STEP + codes[k : k + n])
        return np.unique(out)


def _chosen(tokens: np.ndarray, branching: float, salt: int) -> np.ndarray:
    """Keys of the child nodes that a set goes to from the node (or tree) with this salt."""
    if not len(tokens):
        return tokens
    salt64 = np.uint64(salt & 0xFFFFFFFFFFFFFFFF)
    rank = mix64(tokens ^ mix64(np.array([salt64]) + np.uint64(1))[0])
    limit = np.uint64(min(branching / len(tokens), 1.0) * float(2**64 - 2**12))
    own = tokens[rank <= limit]
    return mix64(own * _STEP + mix64(np.array([salt64]))[0])


def features(docs: DataFrame, *, shingle: int, trees: int = TREES, branching: float = BRANCHING) -> DataFrame:
    """doc_id, n_shingles, set_hi, set_lo (digest of the set), nodes (keys of the first level), sketch."""

    def made(batches):
        own = Shingler(shingle)
        for batch in slices(batches, "text"):
            n, digest, nodes, sketch = [], [], [], []
            for text in utf8_columns(batch, "text"):
                tokens = own(text)
                n.append(len(tokens))
                digest.append(xxhash.xxh3_128_digest(tokens.tobytes()))
                nodes.append(np.concatenate([_chosen(tokens, branching, t) for t in range(trees)]).view(np.int64))
                low = mix64(tokens) >> np.uint64(32)
                sketch.append(np.sort(low)[:SKETCH].astype(np.uint32).tobytes() if len(low) <= 4 * SKETCH else np.sort(np.partition(low, SKETCH)[:SKETCH]).astype(np.uint32).tobytes())
            both = np.frombuffer(b"".join(digest), ">i8").astype(np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(nodes, pa.list_(pa.int64())), pa.array(sketch, pa.binary())], names=["doc_id", "n_shingles", "set_hi", "set_lo", "nodes", "sketch"])

    return docs.mapInArrow(made, "doc_id long, n_shingles long, set_hi long, set_lo long, nodes array<long>, sketch binary")


def _likely(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Of pairs (a, b): those whose sizes allow the similarity and whose sketches have enough in common."""
    side = lambda k: reps.select(F.col("doc_id").alias(k), F.col("n_shingles").alias(f"n_{k}"), F.col("sketch").alias(f"s_{k}"))

    def likely(batches):
        for batch in batches:
            ok = []
            for n_a, n_b, s_a, s_b in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("n_a", "n_b", "s_a", "s_b")), strict=True):
                both = np.concatenate([np.frombuffer(s_a, np.uint32), np.frombuffer(s_b, np.uint32)])
                ok.append(len(both) - len(np.unique(both)) >= SKETCH_SHARE * min(SKETCH, max(n_a, n_b)))
            own = batch.select(["a", "b"])
            yield own.filter(pa.array(ok, pa.bool_()))

    return pairs.join(side("a"), "a").join(side("b"), "b").filter("5 * least(n_a, n_b) >= 4 * greatest(n_a, n_b)").select("a", "b", "n_a", "n_b", "s_a", "s_b").mapInArrow(likely, "a long, b long")


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of docs with these ids; ids are broadcast only if they are few."""
    return docs.join(few_broadcast(ids, BROADCAST_IDS), "doc_id", "left_semi")


def confirmed(pairs: DataFrame, docs: DataFrame, tables: Tables, *, shingle: int, similarity: int) -> DataFrame:
    """Of pairs (a, b) of document ids: those with 100 * intersection >= similarity * union of their full sets.

    The set of a is sent once for every GROUP of its pairs, so that a document with many pairs fills no task.
    """
    groups = pairs.groupBy("a").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("n"))
    members = pairs.join(groups, "a").select(F.col("b").alias("doc_id"), "a", F.pmod(F.xxhash64("b"), F.col("n")).cast("int").alias("part"), F.lit(1).alias("turn"))
    heads = groups.select(F.col("a").alias("doc_id"), "a", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("part"), F.lit(0).alias("turn"))
    sent = tables.keep(members.unionByName(heads))

    def sets(batches):
        own, last, held = Shingler(shingle), None, b""
        for batch in slices(batches, "text"):
            tokens = []
            for text in utf8_columns(batch, "text"):
                if text != last:
                    last, held = text, own(text).tobytes()
                tokens.append(held)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(tokens, pa.binary())], names=["a", "part", "turn", "doc_id", "tokens"])

    rows = docs.join(few_broadcast(sent, BROADCAST_IDS), "doc_id").select("a", "part", "turn", "doc_id", "text")
    full = rows.mapInArrow(sets, "a long, part int, turn int, doc_id long, tokens binary").repartition("a", "part").sortWithinPartitions("a", "part", "turn")

    def similar(batches):
        key, heads = None, []
        for whole in batches:
            for batch in slices([whole], "tokens"):
                found = []
                for a, part, turn, doc_id, tokens in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    y = np.frombuffer(tokens, np.uint64)
                    if (a, part) != key:
                        key, heads = (a, part), []
                    if turn == 0:
                        heads.append(y)
                    elif any(_alike(x, y, similarity) for x in heads):
                        found.append((a, doc_id))
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return tables.keep(full.mapInArrow(similar, "a long, b long"), instead_of=(sent,)).dropDuplicates()


def _inside(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which members of the sorted set x are in the sorted set y."""
    return y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x if len(y) else np.zeros(len(x), bool)


def _alike(x: np.ndarray, y: np.ndarray, similarity: int) -> bool:
    """Whether sorted sets have 100 * intersection >= similarity * union."""
    inside = int(_inside(x, y).sum())
    return inside > 0 and 100 * inside >= similarity * (len(x) + len(y) - inside)


def _order(turn: int) -> F.Column:
    """Order in which documents become pivots: the same in all nodes, so that a large group has few pivots; another in each turn."""
    return F.xxhash64("doc_id", F.lit(turn))


def _open_nodes(members: DataFrame, colors: DataFrame | None, turn: int) -> DataFrame:
    """Members (node, doc_id, color, n, apart, most, pivot, pivot_color) of the nodes that hold more than one color.

    Two documents of one color are connected already. n: size of the node; apart: members whose color isn't `most`, a
    color that is frequent there. The pivot is, of the members without a link if there are any, the first in this turn's
    order.
    """
    if colors is None:
        colored = members.select("node", "doc_id", F.col("doc_id").alias("color"), F.lit(False).alias("linked"))
    else:
        colored = members.join(colors, F.col("doc_id") == F.col("id"), "left").select("node", "doc_id", F.coalesce("component", "doc_id").alias("color"), F.col("id").isNotNull().alias("linked"))
    first = F.min(F.struct("linked", _order(turn).alias("h"), F.col("doc_id").alias("id"), F.col("color").alias("c")))
    by_color = colored.groupBy("node", "color").agg(F.count("*").alias("k"), first.alias("pivot"))
    nodes = by_color.groupBy("node").agg(F.sum("k").alias("n"), F.count("*").alias("colors"), F.max(F.struct("k", "color")).alias("most"), F.min("pivot").alias("pivot")).filter("colors > 1")
    nodes = nodes.select("node", "n", (F.col("n") - F.col("most.k")).alias("apart"), F.col("most.color").alias("most"), F.col("pivot.id").alias("pivot"), F.col("pivot.c").alias("pivot_color"))
    return colored.drop("linked").join(nodes, "node")


def _is_leaf() -> F.Column:
    """Nodes that are compared exhaustively: few members, or few that aren't connected to the rest."""
    return (F.col("n") <= LEAF) | ((F.col("n") <= WIDEST) & (F.col("n") * F.col("apart") <= LEAF * LEAF))


def _branch(members: DataFrame, docs: DataFrame, *, shingle: int, branching: float) -> DataFrame:
    """Members (node, doc_id) of the children of nodes that are too large."""
    by_doc = members.groupBy("doc_id").agg(F.collect_set("node").alias("nodes"))

    def children(batches):
        own = Shingler(shingle)
        for batch in slices(batches, "text"):
            ids, out = [], []
            for doc_id, text, nodes in zip(batch.column(0).to_pylist(), utf8_columns(batch, "text"), batch.column(2).to_pylist(), strict=True):
                tokens = own(text)
                for node in nodes:
                    own_children = _chosen(tokens, branching, node).view(np.int64)
                    out.append(own_children)
                    ids += [doc_id] * len(own_children)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out) if out else np.zeros(0, np.int64), pa.int64()), pa.array(ids, pa.int64())], names=["node", "doc_id"])

    return docs.join(few_broadcast(by_doc, BROADCAST_IDS // 10), "doc_id").select("doc_id", "text", "nodes").mapInArrow(children, "node long, doc_id long").dropDuplicates()


def _leaf_pairs(members: DataFrame, docs: DataFrame, tables: Tables, *, shingle: int, similarity: int) -> DataFrame:
    """Pairs of different color of each node (node, doc_id, color, n) that are likely similar.

    Nodes above LEAF members are dealt into blocks, and every two blocks meet in a task of their own.
    """
    ids = tables.keep(members.select("doc_id").dropDuplicates())

    def sketches(of):
        def made(batches):
            own = Shingler(shingle)
            for batch in slices(batches, "text"):
                tokens = [own(t) for t in utf8_columns(batch, "text")]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(len, tokens), pa.int64()), pa.array([of(mix64(t)) for t in tokens], pa.binary())], names=["doc_id", "n_shingles", "sketch"])

        return made

    def wide(hashes: np.ndarray) -> bytes:
        """Small sets whole, by 64-bit hashes; of others the least hashes, 32 bits of each."""
        return np.sort(hashes).tobytes() if len(hashes) <= WIDE else np.sort(hashes)[:WIDE].__rshift__(np.uint64(32)).astype(np.uint32).tobytes()

    made = "doc_id long, n_shingles long, sketch binary"
    narrow = _texts_of(docs, ids).select("doc_id", "text").mapInArrow(sketches(wide), made).dropDuplicates(["doc_id"])
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = members.select("node", "doc_id", "color", F.when(_is_leaf(), 1).otherwise(blocks).alias("blocks"))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("doc_id", "node"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("node", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "doc_id", "color")
    rows = dealt.join(narrow, "doc_id").repartition("node", "lo", "hi").sortWithinPartitions("node", "lo", "hi")
    found = tables.keep(rows.mapInArrow(_in_groups(_group_pairs, similarity), FOUND), instead_of=(ids,))
    pairs = found.filter("a is not null").select("a", "b")
    dense = found.filter("a is null").select("node", "lo", "hi")
    if not dense.isEmpty():
        again = tables.keep(dealt.join(dense, ["node", "lo", "hi"]))
        sets = _texts_of(docs, again.select("doc_id").dropDuplicates()).select("doc_id", "text").mapInArrow(sketches(lambda hashes: np.sort(hashes).tobytes()), made).dropDuplicates(["doc_id"])
        rows = again.join(sets, "doc_id").repartition("node", "lo", "hi").sortWithinPartitions("node", "lo", "hi")
        pairs = pairs.unionByName(rows.mapInArrow(_in_groups(_dense_links, similarity), FOUND).select("a", "b"))
    return pairs.dropDuplicates()


#: Pairs of ids, or (ids NULL) groups that are to be compared on full sets.
FOUND = "a long, b long, node long, lo int, hi int"


def _found(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    n = len(a)
    return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32())], names=["a", "b", "node", "lo", "hi"])


def _in_groups(find, similarity: int):
    """Apply find to rows that follow one another with equal (node, lo, hi); a group that a batch cuts waits for the next."""

    def compare(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if rest is None else [rest, batch]).combine_chunks()
            if not table.num_rows:
                continue
            key = np.stack([table.column(c).to_numpy() for c in ("node", "lo", "hi")])
            new = np.r_[True, (key[:, 1:] != key[:, :-1]).any(axis=0)]
            last = int(np.flatnonzero(new)[-1])
            if last:
                yield from find(table.slice(0, last), np.cumsum(new[:last]), similarity)
            rest = table.slice(last).combine_chunks().to_batches()[0]
        if rest is not None:
            yield from find(pa.Table.from_batches([rest]), np.zeros(rest.num_rows, np.int64), similarity)

    return compare


class _Forest:
    """Union-find over the rows of a group, so that certain links are passed on only as far as they join something."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (u := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(u, u)
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)
        return x != y


def _group_pairs(table: pa.Table, group: np.ndarray, similarity: int):
    n, ids, color, own, lo, hi = (table.column(c).to_numpy() for c in ("n_shingles", "doc_id", "color", "own", "lo", "hi"))
    # Sketches as rows of one array; free places get values of their own. Signatures: a bit for each hash, by its low byte.
    sketch = np.arange(len(n) * WIDE, dtype=np.uint64).reshape(-1, WIDE) + np.uint64(1 << 32)
    whole = sketch.copy()
    bits = np.zeros((len(n), 16), np.uint64)
    for k, (s, size) in enumerate(zip(table.column("sketch").to_pylist(), n.tolist(), strict=True)):
        few = np.frombuffer(s, np.uint64 if size <= WIDE else np.uint32)
        if size <= WIDE:
            whole[k, :size] = few
            few = few >> np.uint64(32)
        sketch[k, : len(few)] = few
        few = few.astype(np.uint32)
        np.bitwise_or.at(bits[k], (few & 15).astype(np.int64), np.uint64(1) << (few >> np.uint32(4) & np.uint32(63)).astype(np.uint64))
    step, at, forest, likely = 1, np.arange(max(len(n) - 1, 0)), {}, []
    while len(at):
        at = at[at + step < len(n)]
        at = at[group[at] == group[at + step]]
        i, j = at, at + step
        ok = _comparable(n, ids, color, own, lo, hi, i, j, similarity)
        i, j = i[ok], j[ok]
        most = np.maximum(n[i], n[j])
        # Similar sets share at least half of their smallest hashes, less a few that fall on one bit.
        near = np.bitwise_count(bits[i] & bits[j]).sum(axis=1) >= 0.45 * np.minimum(WIDE, most) - 2
        i, j, most = i[near], j[near], most[near]
        for k in range(0, len(i), 10_000):
            p, q, m = i[k : k + 10_000], j[k : k + 10_000], most[k : k + 10_000]
            known = m <= WIDE
            maybe = np.flatnonzero(~known)
            maybe = maybe[_common(sketch[p[maybe]], sketch[q[maybe]]) >= WIDE_SHARE * WIDE]
            likely.append((p[maybe], q[maybe]))
            p, q = p[known], q[known]
            common = _common(whole[p], whole[q])
            certain = 100 * common >= similarity * (n[p] + n[q] - common)
            yield from _spanning(ids, color, group, p[certain], q[certain], forest)
        step += 1
    if not likely:
        return
    p, q = (np.concatenate(x) for x in zip(*likely, strict=True))
    size, pairs = np.bincount(group), np.bincount(group[p], minlength=int(group.max()) + 1)
    heavy = pairs > DENSE * size
    light = ~heavy[group[p]]
    yield _found(ids[p[light]], ids[q[light]])
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    first = first[heavy[group[first]]]
    none = pa.nulls(len(first), pa.int64())
    yield pa.RecordBatch.from_arrays([none, none, *(table.column(c).combine_chunks().take(pa.array(first)) for c in ("node", "lo", "hi"))], names=["a", "b", "node", "lo", "hi"])


def _common(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Number of equal values of two rows, for rows that hold no value twice."""
    both = np.sort(np.concatenate([x, y], axis=1), axis=1)
    return (both[:, 1:] == both[:, :-1]).sum(axis=1)


def _comparable(n, ids, color, own, lo, hi, i, j, similarity: int) -> np.ndarray:
    """Which pairs of rows differ in color, may be similar by their sizes, and are to meet in their blocks' task."""
    most, least = np.maximum(n[i], n[j]), np.minimum(n[i], n[j])
    return (color[i] != color[j]) & (ids[i] != ids[j]) & (100 * least >= similarity * most) & ((lo[i] == hi[i]) | (own[i] != own[j]))


def _spanning(ids, color, group, i, j, forest: dict):
    """Of certain links those that join something in their group."""
    keep = [r for r, (g, x, y) in enumerate(zip(group[i].tolist(), color[i].tolist(), color[j].tolist(), strict=True)) if forest.setdefault(g, _Forest()).join(x, y)]
    if keep:
        yield _found(ids[i[keep]], ids[j[keep]])


def _dense_links(table: pa.Table, group: np.ndarray, similarity: int):
    """Links of groups of near-copies, from exact intersections of full sets: products of 0/1 matrices over the hashes
    that at least two members hold."""
    n, ids, color, own, lo, hi = (table.column(c).to_numpy() for c in ("n_shingles", "doc_id", "color", "own", "lo", "hi"))
    sets = [np.frombuffer(s, np.uint64) for s in table.column("sketch").to_pylist()]
    edges = np.r_[np.flatnonzero(np.r_[True, group[1:] != group[:-1]]), len(group)]
    forest: dict[int, _Forest] = {}
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        _, code, count = np.unique(np.concatenate(sets[a:b]), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(b - a), [len(s) for s in sets[a:b]])
        place = np.cumsum(count > 1) - 1
        held = count[code] > 1
        row, code = row[held], place[code[held]]
        order = np.argsort(code, kind="stable")
        row, code = row[order], code[order]
        common = np.zeros((b - a, b - a), np.float32)
        for start in range(0, int((count > 1).sum()), 4096):
            x, y = np.searchsorted(code, [start, start + 4096])
            part = np.zeros((b - a, 4096), np.float32)
            part[row[x:y], code[x:y] - start] = 1
            for top in range(0, b - a, ROWS):
                common[top : top + ROWS] += part[top : top + ROWS] @ part.T
        for top in range(0, b - a, ROWS):
            own_rows = common[top : top + ROWS]
            i, j = np.nonzero(100 * own_rows >= similarity * (n[a + top : a + top + len(own_rows), None] + n[None, a:b] - own_rows))
            i, j = i + a + top, j + a
            i, j = i[i < j], j[i < j]
            ok = _comparable(n, ids, color, own, lo, hi, i, j, similarity)
            yield from _spanning(ids, color, group, i[ok], j[ok], forest)


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    similarity: int = 80,
    trees: int = TREES,
    branching: float = BRANCHING,
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs.

    Rows whose sets have 100 * intersection >= similarity * union are linked; component_id is the smallest id that is
    reachable, kept is doc_id = component_id. Null texts and texts without words have empty sets and no links; a text of
    fewer words than a shingle is one shingle. Rows without id keep to themselves (component_id null, kept). Rows of one
    id are one document. similarity is a whole percentage of at least 80: sizes are compared by that bound.
    """
    if similarity < 80:
        raise ValueError("similarity must be at least 80")
    texts, tables, sets = id_text(docs, id_col, text_col), Tables(docs.sparkSession), ["set_hi", "set_lo", "n_shingles"]
    feats = tables.keep(features(texts, shingle=shingle, trees=trees, branching=branching))
    first = F.min(F.struct("doc_id", "nodes", "sketch")).alias("first")
    reps = tables.keep(feats.filter("n_shingles > 0 and doc_id is not null").groupBy(*sets).agg(first).select(*sets, "first.*"))
    grown = {"shingle": shingle, "similarity": similarity}
    links = colors = None
    turn = 0

    def starred(level: DataFrame) -> DataFrame:
        """Link the members to their nodes' pivots; the nodes that are open after that."""
        nonlocal links, colors, turn
        pairs = level.filter("color <> pivot_color").select(F.col("pivot").alias("a"), F.col("doc_id").alias("b")).dropDuplicates()
        likely = tables.keep(_likely(pairs, reps))
        found = confirmed(likely, texts, tables, **grown)
        links = tables.keep(found if links is None else links.unionByName(found), instead_of=(likely, links))
        turn += 1
        colors = tables.keep(components(links), instead_of=(colors,))
        return tables.keep(_open_nodes(level.select("node", "doc_id"), colors, turn), instead_of=(level,))

    level = tables.keep(_open_nodes(reps.select(F.explode(F.array_distinct("nodes")).alias("node"), "doc_id").dropDuplicates(), None, turn))
    for _ in range(STAR_ROUNDS):
        level = starred(level)
    found = []
    for depth in range(1, MAX_DEPTH + 1):
        last = depth == MAX_DEPTH
        small = level if last else level.filter(_is_leaf())
        large = level.filter(~_is_leaf())
        if not small.isEmpty():
            pairs = tables.keep(_leaf_pairs(small, texts, tables, **grown))
            found.append(tables.keep(confirmed(pairs, texts, tables, **grown), instead_of=(pairs,)))
        if last or large.isEmpty():
            break
        level = tables.keep(_open_nodes(_branch(large.select("node", "doc_id"), texts, shingle=shingle, branching=DEEPER), colors, turn), instead_of=(level,))
    edges = reduce(DataFrame.unionByName, found, links)
    labels = tables.keep(components(edges)).withColumnRenamed("id", "rep")
    classes = reps.select(*sets, F.col("doc_id").alias("rep"))
    out = feats.select("doc_id", *sets).join(classes, sets, "left").join(labels, "rep", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
