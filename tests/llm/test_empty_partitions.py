"""Every operator on tables with empty partitions and on tables whose rows are all filtered out."""

import pytest

from tidemark.llm import language_id, quality, secret_scan
from tidemark.llm.bm25 import top_k
from tidemark.llm.decontaminate import decontaminate
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.mixing import mix
from tidemark.llm.near_dedup import near_duplicates
from tidemark.llm.substring_dedup import remove_repeats
from tidemark.llm.token_counts import count_tokens

OPERATORS = {
    "op1": lambda d, m: count_tokens(d, "word_bpe_49k.json"),
    "op2": decontaminate,
    "op3": lambda d, m: near_duplicates(d, shingle=4, similarity=80),
    "op4": lambda d, m: language_id.identify(d, language_id.fit(d)),
    "op5": lambda d, m: top_k(d, d, k=2),
    "op6": lambda d, m: mix(d),
    "op7": lambda d, m: remove_repeats(d, length=20),
    "op8": lambda d, m: secret_scan.scan(d),
    "op9": lambda d, m: quality.score(d, quality.fit(d)),
    "op10": lambda d, m: dedup_lines(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_partitions_and_filtered_tables(spark, name):
    docs = spark.createDataFrame([(1, "one two three four five six", "en", "s", 1), (2, "seven eight nine ten eleven", "de", "t", 0)], "doc_id long, text string, lang string, source string, quality int").repartition(4)
    items = spark.createDataFrame([("i", "two three")], "item_id string, text string").repartition(3)
    rows = OPERATORS[name](docs, items).collect()
    assert len(rows) == 2
    assert OPERATORS[name](docs.filter("length(text) > 1000"), items.filter("length(text) > 1000")).count() == 0
