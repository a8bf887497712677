"""Secret scan with DataFrame functions only: fixed patterns, and character Markov models compared by log-likelihood ratio.

Fixed patterns give the base spans. Besides, every token of 20 or more key characters that holds a letter and a digit is
scored by two first-order character Markov models, one of random strings and one of ordinary identifiers and words, and
becomes a span if its mean log-likelihood ratio is high. A token of over 200 characters is scored in overlapping pieces,
each as a token of its length would be, and becomes a span if one of them is high. Both models are trained from labelled samples of the corpus:
values of base spans are labelled random, long words and identifiers outside them ordinary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Tables

#: Fixed patterns, in listed order: kind, pattern, least length of what counts.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
MIN_ASSIGN, MIN_ACCESS = 8, 16
KINDS = ("assign", "access", "hex", "markov")

#: Tokens that the Markov models judge.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Longer tokens are scored in pieces of at most so many characters, one from each half of that many on.
PIECE = 200
#: Characters of the models; any other is the last state.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
STATES = len(ALPHABET) + 1
#: Mean log-likelihood ratio for each transition from which a token is random.
MIN_RATIO = 0.3
#: Labelled strings of each class that the models are trained on, at most about.
SAMPLE_STRINGS = 20_000
SMOOTH = 0.5

#: Marks the ends of matches; texts hold none, as it is first replaced by its neighbour, which no pattern matches either.
_MARK, _OTHER = "\x01", "\x02"
_SPAN = "struct<kind:int,start:int,stop:int,found:string>"


def _pieces(text: Column, pattern: str) -> Column:
    """The text cut at both ends of each leftmost non-overlapping match: every second piece is a match."""
    return F.split(F.regexp_replace(text, f"(?s){pattern}", f"{_MARK}$0{_MARK}"), _MARK)


def _matches(text: Column, pattern: str, kind: int, keep) -> Column:
    """Array of (kind, start, stop, found) in code points, of those matches that keep() accepts."""
    start = F.struct(F.lit(0).alias("at"), F.lit(False).alias("inside"), F.array().cast(f"array<{_SPAN}>").alias("spans"))

    def step(acc: Column, piece: Column) -> Column:
        n = F.length(piece)
        span = F.struct(F.lit(kind).alias("kind"), acc["at"].alias("start"), (acc["at"] + n).alias("stop"), piece.alias("found"))
        spans = F.when(acc["inside"] & keep(piece), F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct((acc["at"] + n).alias("at"), (~acc["inside"]).alias("inside"), spans.alias("spans"))

    none = F.array().cast(f"array<{_SPAN}>")
    pieces = _pieces(text, pattern)
    return F.when(F.regexp_like(text, F.lit(pattern)), F.aggregate(pieces, start, step, lambda acc: acc["spans"])).otherwise(none)


def base_spans(text: Column) -> list[Column]:
    """Spans of the three fixed kinds; matches that are too short are dropped, but what they covered stays covered."""
    return [
        _matches(text, ASSIGN, 0, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= MIN_ASSIGN),
        _matches(text, ACCESS, 1, lambda m: F.length(m) >= MIN_ACCESS),
        _matches(text, HEX, 2, lambda m: F.lit(True)),
    ]


def _states(s: Column) -> Column:
    """Characters of a string as model states."""
    at = F.transform(F.split(s, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    return F.transform(at, lambda i: F.when(i == 0, STATES - 1).otherwise(i - 1))


def _transitions(s: Column) -> Column:
    """Numbers of the transitions of a string, as state * STATES + next state."""
    states = _states(s)
    return F.zip_with(F.slice(states, F.lit(1), F.size(states) - 1), F.slice(states, F.lit(2), F.size(states) - 1), lambda a, b: a * STATES + b)


def _scored_pieces(token: Column) -> Column:
    """The token itself, or overlapping pieces that cover it: every stretch of half a piece lies whole in one of them."""
    half = PIECE // 2
    pieces = F.regexp_extract_all(token, F.lit(f"(?=(.{{{half},{PIECE}}})).{{1,{half}}}"), F.lit(1))
    return F.when(F.length(token) > PIECE, pieces).otherwise(F.array(token))


def train(samples: DataFrame) -> DataFrame:
    """One row with `ratio`: an array of log(p_random / p_ordinary) by transition, from rows of (found, random boolean).

    The table has STATES^2 entries whatever the corpus; transitions are counted with map-side combination.
    """
    counts = samples.select("random", F.explode(_transitions(F.col("found"))).alias("t")).groupBy("t").agg(F.count_if("random").alias("r"), F.count_if(~F.col("random")).alias("o"))
    cells = samples.sparkSession.range(STATES * STATES).select(F.col("id").cast("int").alias("t")).join(counts, "t", "left").fillna(0, ["r", "o"])
    row = F.floor(F.col("t") / STATES).cast("int").alias("from")
    totals = cells.groupBy(row).agg(F.sum("r").alias("rs"), F.sum("o").alias("os"))
    p = lambda n, all_n: (F.col(n) + SMOOTH) / (F.col(all_n) + SMOOTH * STATES)
    ratios = cells.withColumn("from", row).join(totals, "from").select("t", F.log(p("r", "rs") / p("o", "os")).alias("ratio"))
    return ratios.agg(F.transform(F.array_sort(F.collect_list(F.struct("t", "ratio"))), lambda x: x["ratio"]).alias("ratio"))


def labelled_samples(rows: DataFrame, sample_strings: int = SAMPLE_STRINGS) -> DataFrame:
    """(found, random): distinct values of base spans and base64 digests of row ids are random, distinct words and
    identifiers of letters ordinary; each kind is drawn by hash.

    rows: doc_id, text, base (array of base spans).
    """
    value = F.coalesce(F.nullif(F.regexp_extract("s.found", ASSIGN, 2), F.lit("")), F.col("s.found"))
    random = rows.select(F.explode("base").alias("s")).select(value.alias("found")).filter(F.regexp_like("found", F.lit("[0-9]"))).distinct()
    words = rows.select(F.explode(F.regexp_extract_all("text", F.lit(r"(?<![A-Za-z0-9+/_=-])[A-Za-z_]{8,40}(?![A-Za-z0-9+/_=-])"), F.lit(0))).alias("found"))
    words = words.distinct()
    made = rows.select(F.base64(F.unhex(F.sha2(F.concat(F.lit("random:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256))).alias("found"))

    tables = Tables(rows.sparkSession)

    def drawn(df: DataFrame, label: bool) -> DataFrame:
        """Strings whose hash lies under the share that the sample is of all of them; no row travels for it."""
        df = tables.keep(df)
        share = min(1.0, sample_strings / max(df.count(), 1))
        h = F.pmod(F.xxhash64("found", F.lit("sample")), F.lit(1 << 30))
        return df.filter(h < share * (1 << 30)).withColumn("random", F.lit(label))

    return drawn(random, True).unionByName(drawn(made, True)).unionByName(drawn(words, False))


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_ratio: float = MIN_RATIO, sample_strings: int = SAMPLE_STRINGS) -> DataFrame:
    """doc_id, text, spans (array of kind, start, stop, found; by start, then kind as listed) for each row.

    Positions are code points, stop exclusive. Null and empty texts have no spans. Spans of the Markov models that
    overlap a base span are left out. Nothing is shuffled but the samples. Rows without id or of equal id are scanned one
    by one; an empty table gives an empty one.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("text", F.when(F.instr("text", _MARK) > 0, F.replace("text", F.lit(_MARK), F.lit(_OTHER))).otherwise(F.col("text")))
    based = rows.withColumn("base", F.concat(*base_spans(F.col("text"))))
    ratios = train(labelled_samples(based, sample_strings))

    def worth(m: Column) -> Column:
        return F.regexp_like(m, F.lit("[0-9]")) & F.regexp_like(m, F.lit("[A-Za-z]"))

    def apart(c: Column) -> Column:
        return ~F.exists("base", lambda b: (b["start"] < c["stop"]) & (c["start"] < b["stop"]))

    def ratio(piece: Column) -> Column:
        moves = _transitions(piece)
        return F.aggregate(moves, F.lit(0.0), lambda acc, t: acc + F.element_at("ratio", t + 1)) / F.greatest(F.size(moves), F.lit(1))

    found = based.withColumn("tokens", F.filter(_matches(F.col("text"), CANDIDATE, 3, worth), apart))
    found = found.crossJoin(F.broadcast(ratios)).withColumn("tokens", F.filter("tokens", lambda c: F.exists(_scored_pieces(c["found"]), lambda piece: ratio(piece) >= min_ratio)))
    return found.select("doc_id", "text", F.array_sort(F.concat("base", "tokens"), _by_place).alias("spans"))


def _by_place(a: Column, b: Column) -> Column:
    order = [F.when(a[k] < b[k], -1).when(a[k] > b[k], 1) for k in ("start", "kind")]
    return F.coalesce(*order, F.lit(0))


def digest(spans: Column) -> Column:
    """kind:start:stop of spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")
