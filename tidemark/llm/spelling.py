"""Spelling variants by a relational trie frontier: words one edit apart, and the frequent form that each goes back to.

The trie of all words, each spelt from the front and from the back, is a table of nodes with their edges (label, child).
Chains without a branch are one edge, so there are at most two edges a text; inner nodes are what neighbours in sorted order
have in common. States (text, position, node, edits) start with every text at the root and join the edges round by round. A
state without an edit goes along its own text; from the text's middle on it also spawns one-edit states where the trie
branches, which must follow the rest of their text. One that ends with its text at a node that is a text makes a pair. An
edit in a word's first half is found from the back, where the trie has few branches at that place.

A pair is found from one side only, that of the smaller letter or of the longer word, and mirrored. The 500 nodes of the
most states get their edges by broadcast; any other holds less than a 500th of the states. There are as many rounds as
edges on the longest path.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Tables, few_broadcast, id_text, slices, utf8_columns

#: What a run is made of, after A-Z are lower-cased.
_RUN = re.compile("[a-zÀ-ÿ]+")
#: What is put before a word spelt from the front and from the back.
FRONT, BACK = ">", "<"
#: As many nodes of the most states get their edges by broadcast, if they hold so many states.
HOT_NODES, HOT_STATES = 500, 256
#: Entries and characters of counts that a task holds.
HELD_WORDS, HELD_CHARS = 300_000, 16 << 20


def vocabulary(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6, min_count: int = 5, drop_every: int | None = None) -> DataFrame:
    """(word, n): runs of letters with A-Z in lower case, of at least min_length code points and min_count occurrences.

    drop_every: a run whose crc32 of `<doc_id>:<run>` that number divides loses code point crc32 % length first. A null text
    has no runs; a null id is an empty string in the digest; repeated rows count again.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        chars = 0

        def emit() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

        for batch in slices(batches, "text"):
            for doc, raw in zip(batch.column(0).to_pylist(), utf8_columns(batch, "text"), strict=True):
                if not raw:
                    continue
                runs = Counter(_RUN.findall(raw.lower().decode("utf-8", "replace")))
                before = zlib.crc32(b"%s:" % (b"" if doc is None else b"%d" % doc))
                for run, n in runs.items():
                    if drop_every and (h := zlib.crc32(run.encode(), before)) % drop_every == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                    if len(run) >= min_length:
                        if run not in held:
                            chars += len(run)
                        held[run] += n
                if len(held) > HELD_WORDS or chars > HELD_CHARS:
                    yield emit()
                    held.clear()
                    chars = 0
        if held:
            yield emit()

    counts = id_text(docs, id_col, text_col).mapInArrow(counted, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def common_length(a: str, b: str) -> int:
    return len(os.path.commonprefix([a, b]))


def with_shared(texts: DataFrame, tables: Tables) -> DataFrame:
    """(text, n, shared): the length of what each distinct text has in common with the one before it in code-point order.

    Texts are dealt and sorted by range; of each range only the first and last text go to the driver.
    """

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last = TaskContext.get().partitionId(), None
        for batch in batches:
            words = batch.column(0).to_pylist()
            out = [None if a is None else common_length(a, b) for a, b in zip([last, *words], words, strict=False)]
            last = words[-1] if words else last
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int32()), pa.array([part] * len(words), pa.int32())], names=["text", "n", "shared", "part"])

    table = tables.keep(texts.select("text", "n").repartitionByRange("text").sortWithinPartitions("text").mapInArrow(shared, "text string, n long, shared int, part int"))
    ends = sorted(table.groupBy("part").agg(F.min("text").alias("first"), F.max("text").alias("last")).collect(), key=lambda r: r.part)
    over = [(b.part, common_length(a.last, b.first)) for a, b in zip(ends, ends[1:], strict=False)]
    heads = table.sparkSession.createDataFrame(over, "part int, over int")
    return table.join(F.broadcast(heads), "part", "left").select("text", "n", F.coalesce("shared", "over", F.lit(0)).alias("shared"))


def both_ways(words: DataFrame) -> DataFrame:
    """(text, n): each word from the front, after FRONT, and from the back, after BACK."""
    texts = F.array(F.concat(F.lit(FRONT), "word"), F.concat(F.lit(BACK), F.reverse("word")))
    return words.select(F.explode(texts).alias("text"), "n")


def word_of(text: str) -> Column:
    bare = F.substring(text, F.lit(2), F.length(text))
    return F.when(F.col(text).startswith(FRONT), bare).otherwise(F.reverse(bare))


def trie_nodes(texts: DataFrame, tables: Tables) -> DataFrame:
    """(node, edges): each inner node's edges by the first letter of their labels, no more than letters: label, child and the
    count of a child that is a text."""
    inner = with_shared(texts, tables).filter("shared > 0").select(F.substring("text", F.lit(1), F.col("shared")).alias("text"), F.lit(None).cast("long").alias("n"))
    every = texts.unionByName(inner).groupBy("text").agg(F.max("n").alias("n"))
    label = F.substring("text", F.col("shared") + 1, F.length("text"))
    edge = F.struct(F.substring(label, 1, 1).alias("key"), F.struct(label.alias("label"), F.col("text").alias("child"), F.col("n").alias("child_n")).alias("value"))
    placed = with_shared(every, tables).select(F.substring("text", F.lit(1), F.col("shared")).alias("node"), edge.alias("edge"))
    return tables.keep(placed.groupBy("node").agg(F.map_from_entries(F.collect_list("edge")).alias("edges")))


def _piece(text: Column, at: Column, size: Column) -> Column:
    """size code points from the 0-based position on; fewer at the text's end."""
    return F.substring(text, at + 1, size)


def _steps(joined: DataFrame) -> DataFrame:
    """States after one edge: one with its edit, or still in the part that must agree, follows its next letter; others try
    all edges of their node."""
    text, pos = F.col("text"), F.col("pos")
    label, head = F.col("edge.label"), F.substring("edge.label", 1, 1)
    size, rest, length = F.length(label), F.substring(label, F.lit(2), F.length(label)), F.length(text) - 1
    here, following = _piece(text, pos, F.lit(1)), _piece(text, pos + 1, F.lit(1))
    half = F.floor(length / 2)
    # The middle letter's edits are found from the front.
    may = (F.col("edits") == 0) & (pos > F.when(text.startswith(FRONT), half).otherwise(length - half))

    def to(at: Column, edits: Column) -> Column:
        return F.struct(at.cast("int").alias("pos"), edits.alias("edits"))

    out = F.array(
        F.when((head == here) & (label == _piece(text, pos, size)), to(pos + size, F.col("edits"))),
        F.when(may & (head > here) & (rest == _piece(text, pos + 1, size - 1)), to(pos + size, F.lit(1))),  # another letter
        F.when(may & (head == following) & (here != following) & (label == _piece(text, pos + 1, size)), to(pos + 1 + size, F.lit(1))),  # one less
    )
    tried = F.when(may, F.map_values("edges")).otherwise(F.array_compact(F.array(F.try_element_at("edges", here))))
    each = joined.select("text", "n", "pos", "edits", F.explode(tried).alias("edge"))
    state = each.select("text", "n", F.col("edge.child").alias("node"), F.col("edge.child_n").alias("node_n"), F.explode(F.array_compact(out)).alias("s"))
    state = state.select("text", "n", F.col("s.pos").alias("pos"), "node", "node_n", F.col("s.edits").alias("edits"))
    return state.filter((F.col("pos") < F.length("text")) | (F.col("edits") == 1) & F.col("node_n").isNotNull())


def one_edit_pairs(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): each ordered pair of distinct words one inserted, deleted or replaced code point apart, once."""
    tables = Tables(words.sparkSession)
    texts = both_ways(words)
    nodes = trie_nodes(texts, tables)
    live = texts.select("text", "n", F.lit(0).alias("pos"), F.lit("").alias("node"), F.lit(None).cast("long").alias("node_n"), F.lit(0).alias("edits"))
    pairs = texts.select("text", "n", F.col("text").alias("node"), F.col("n").alias("node_n")).limit(0)
    # No node but the HOT_NODES of most states can hold more than that part of all states.
    while most := live.groupBy("node").count().orderBy(F.desc("count"), "node").limit(HOT_NODES).collect():
        hot = F.col("node").isin([r.node for r in most if r["count"] >= HOT_STATES])
        joined = live.filter(hot).join(F.broadcast(nodes.filter(hot)), "node").unionByName(live.filter(~hot).join(nodes, "node"))
        table = tables.keep(_steps(joined))
        # Without an edit and with one letter left: the node is the word without it.
        done = F.when(F.col("edits") == 1, F.col("pos") == F.length("text")).otherwise(F.col("pos") + 1 == F.length("text"))
        pairs = pairs.unionByName(table.filter(done & F.col("node_n").isNotNull()).select("text", "n", "node", "node_n"))
        live = table.filter(F.col("pos") < F.length("text"))
    found = pairs.select(word_of("text").alias("word"), "n", word_of("node").alias("near"), F.col("node_n").alias("near_n"))
    mirrored = found.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    # A letter less within a run of equal letters across the middle is found from both ends.
    return found.unionByName(mirrored).dropDuplicates(["word", "near"])


def spelling_variants(words: DataFrame, *, ratio: int = 5) -> DataFrame:
    """word, n, n_near, form, form_n, root for each row of (word, n); words are distinct and not null.

    form: the near word of largest n (ties: the smallest in code-point order) if that is at least ratio * n, else null; root:
    where forms lead from the word, itself without a form. Every form has at least `ratio` times the occurrences, so
    chains end after a few steps. An empty table gives an empty one.
    """
    tables = Tables(words.sparkSession)
    words = tables.keep(words.select("word", "n"))
    best = one_edit_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    takes = -F.col("best.minus") >= ratio * F.col("n")
    table = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(takes, F.col("best.near")).alias("form"), F.when(takes, -F.col("best.minus")).alias("form_n"))
    table = tables.keep(table)
    roots = tables.keep(table.filter("form is not null").select("word", F.col("form").alias("root")))
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        moved = tables.keep(roots.join(few_broadcast(ahead), "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")))
        roots = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            break
    return table.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
