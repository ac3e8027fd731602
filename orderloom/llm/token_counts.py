"""Token counts with a shortcut for words that are one token.

Before any row is read, every vocabulary string is merged alone: those that end as one token
are proven whole. A pre-token that is such a string counts one without merging; only the rest
is merged, once per distinct piece of text a task remembers.

Defined cases: null text is empty and has no tokens; special strings inside a text count one
token each, as the library's default has it; very long texts are counted whole, in one task; a null id is
allowed; repeated rows are counted each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import bytelevel
from orderloom.llm.common import map_rows, shared, table, text_of

TOKEN_LIMIT = 512
MEMORY_PIECES = 600_000
# Longer words are merged with a heap, whose cost grows hardly faster than the word.
PLAIN_MERGE_BYTES = 64


def whole_tokens(vocabulary: bytelevel.Vocabulary) -> frozenset[bytes]:
    """The vocabulary strings that are encoded alone as one token, each proven by merging it."""
    return frozenset(b for b, n in vocabulary.id_of.items() if vocabulary.merged_long(b) == [n])


class Counter:
    def __init__(self, vocabulary: bytelevel.Vocabulary, whole: frozenset[bytes]):
        self.vocabulary, self.split = vocabulary, bytelevel.splitter(vocabulary.special)
        # As text where the bytes are UTF-8; other whole tokens never equal a pre-token.
        self.whole = {t for t in (b.decode("utf-8", "ignore") for b in whole) if t.encode() in whole}
        self.known: dict[str, int] = {}
        self.merged: dict[str, int] = {}

    def word(self, word: str) -> int:
        if word in self.whole:
            return 1
        count = self.merged.get(word)
        if count is None:
            data = word.encode()
            long = len(data) > PLAIN_MERGE_BYTES
            count = len(self.vocabulary.merged_long(data) if long else self.vocabulary.merged(data))
            if len(self.merged) >= MEMORY_PIECES:
                self.merged.clear()
            self.merged[word] = count
        return count

    def piece(self, text: str) -> int:
        return sum([self.word(w) for w in bytelevel.pre_tokens(text)])

    def text(self, text: str) -> int:
        known, total = self.known, 0
        for k, part in enumerate(self.split(text)):
            if k % 2:
                total += 1
                continue
            found = bytelevel.pieces(part)
            total += self.piece(found[0])
            try:
                total += sum([known[p] for p in found[1:]])
            except KeyError:
                new = set(found[1:]).difference(known)
                if len(known) + len(new) > MEMORY_PIECES:
                    known.clear()
                    new = set(found[1:])
                known.update((p, self.piece(f" {p}")) for p in new)
                total += sum([known[p] for p in found[1:]])
        return total


_COUNTERS: dict[str, Counter] = {}


def count_tokens(
    df: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", limit: int = TOKEN_LIMIT
) -> DataFrame:
    """``id, n_bytes, n_tokens, over_limit`` per row, as the tokenizers library counts."""
    vocabulary = bytelevel.Vocabulary(path)
    sent = shared(df.sparkSession, (vocabulary, whole_tokens(vocabulary)))
    kind = df.schema[id_column].dataType.simpleString()

    def run(columns):
        if path not in _COUNTERS:
            _COUNTERS[path] = Counter(*sent())
        counter = _COUNTERS[path]
        return {
            id_column: columns[id_column],
            "n_bytes": [len(t.encode()) for t in columns["text"]],
            "n_tokens": [counter.text(t) for t in columns["text"]],
        }

    rows = df.select(id_column, text_of(text_column).alias("text"))
    counted = map_rows(rows, run, f"`{id_column}` {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), bytelevel.vocabulary_path())
