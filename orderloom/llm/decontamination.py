"""Benchmark decontamination: BM25 over an inverted index of test items, with block maxima.

Test items are indexed by word; postings are kept per block of items with the largest BM25
contribution a word has inside the block. A document is cut into overlapping passages and every
passage is a query. A passage is dropped when the bounds of its words cannot reach the lowest
threshold; then whole blocks are dropped by their own maxima; only the items of the blocks that
remain are scored. All items above their threshold are retrieved, none by rank. The document is
then verified around the passage: both the question and the answer of the item must overlap.

An item's last sentence is its answer, the rest its question; an item of one sentence is cut
in the middle. The overlap of a part is the share of its shingles of five words that occur in
the passage's neighbourhood. Both parts must reach 0.8.

The index holds the benchmark, not the corpus. Its size is checked: up to ``INDEX_ITEMS`` items
it is sent to every executor at once, beyond that in slices of that many items, one pass over
the documents for each, so memory is bounded for any benchmark. Document frequencies, mean and
longest length are counted once over all items by Spark, and passages start at the same words in
every slice, so the results are the same for any number of slices.

Passages are ``PASSAGE`` times as long as the longest item and overlap by more than that item, so
every full occurrence lies inside one passage. Very long documents are worked off passage by passage.

Defined cases: null and empty texts match nothing; items without words are no items; repeated
rows and repeated items are reported each; items of under five words must occur as they are;
an empty benchmark or an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.common import map_rows, shared, table, text_of
from orderloom.session import materialize

K1, B = 1.2, 0.75
#: Items with this share of their own full score are retrieved.
THRESHOLD = 0.6
OVERLAP = 0.8
SHINGLE = 5
BLOCK_ITEMS = 16
INDEX_ITEMS = 4_096
#: Words times blocks that one lookup may gather.
GATHERED = 2_000_000
#: Rows that one lookup holds as Python values; their words weigh many times their text.
LOOKUP_ROWS = 256
#: Passage length as a multiple of the longest item; they overlap by one such item and a half.
PASSAGE = 3

_WORDS = re.compile(r"\w+").findall
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


def words_of(text: str) -> list[str]:
    return _WORDS(text.lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    sentences = [w for w in map(words_of, _SENTENCE.split(text)) if w]
    if len(sentences) > 1:
        return [w for s in sentences[:-1] for w in s], sentences[-1]
    words = sentences[0] if sentences else []
    return words[: (len(words) + 1) // 2], words[(len(words) + 1) // 2 :]


def shingles(words: list[str], width: int = SHINGLE) -> set[tuple[str, ...]]:
    """All runs of ``width`` words; a shorter sequence is one shingle."""
    if len(words) <= width:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(width))))


class Totals(NamedTuple):
    """Items with words, their words with repeats, and the words of the longest."""

    items: int
    words: int
    longest: int


class Index:
    """An inverted index of items with block maxima. Plain arrays, so that it can be broadcast."""

    def __init__(
        self, items: list[tuple[int, str]], block_items: int = BLOCK_ITEMS, totals: Totals | None = None,
        appears: dict[str, int] | None = None,
    ):
        """``totals`` and ``appears``, the items that hold each word, are those of ``items`` unless given."""
        kept = [(key, text, words_of(text)) for key, text in items]
        # Items of near length share a block, which keeps its maxima close to each item's own.
        kept = sorted((x for x in kept if x[2]), key=lambda x: len(x[2]))
        self.keys = [key for key, _, _ in kept]
        self.lengths = [len(w) for _, _, w in kept]
        self.parts = [tuple(map(shingles, question_and_answer(text))) for _, text, _ in kept]
        self.needed = [[(sorted({len(s) for s in p}), p) for p in parts if p] for parts in self.parts]
        if totals is None:
            totals = Totals(len(kept), sum(self.lengths), max(self.lengths, default=1))
            appears = Counter(w for _, _, ws in kept for w in set(ws))
        mean, n = totals.words / max(1, totals.items), len(kept)
        # In the order of the words, so that scores are summed alike in every slice.
        self.word_ids = {w: k for k, w in enumerate(sorted({w for _, _, ws in kept for w in ws}))}
        idf = {w: math.log(1 + (totals.items - appears[w] + 0.5) / (appears[w] + 0.5)) for w in self.word_ids}
        self.full = np.zeros(n)
        self.blocks, self.block_items = max(1, -(-n // block_items)), block_items
        self.block_best = np.zeros((len(self.word_ids), self.blocks), "f4")
        postings: list[list[tuple[int, float]]] = [[] for _ in self.word_ids]
        for item, (_, _, ws) in enumerate(kept):
            for w, c in Counter(ws).items():
                worth = idf[w] * c * (K1 + 1) / (c + K1 * (1 - B + B * len(ws) / mean))
                k = self.word_ids[w]
                postings[k].append((item, worth))
                self.full[item] += worth
                self.block_best[k, item // block_items] = max(self.block_best[k, item // block_items], worth)
        #: The postings of word k are the entries from first[k] up to first[k + 1].
        self.first = np.cumsum([0, *map(len, postings)])
        self.item_of = np.array([i for p in postings for i, _ in p], "i8")
        self.worth_of = np.array([w for p in postings for _, w in p], "f8")
        self.least = THRESHOLD * self.full * (1 - 1e-9)
        # Bounds are summed in single precision, so the blocks' thresholds leave it some room.
        self.block_least = np.array(
            [self.least[b * block_items : (b + 1) * block_items].min(initial=np.inf) for b in range(self.blocks)]
        ) * (1 - 1e-4)
        self.longest = totals.longest
        self.window = PASSAGE * self.longest
        self.step = self.window - self.longest - self.longest // 2

    def starts(self, total: int) -> np.ndarray:
        """Where the passages of a text of ``total`` words start."""
        return np.arange(0, max(1, total - self.longest // 2), self.step)

    def retrieve(self, texts: list[np.ndarray], most: int | None = None) -> list[tuple[int, int, int, float]]:
        """(text, start, item, score) of every passage and item whose BM25 score reaches its threshold.

        All passages of the given texts, or those that start before ``most``, are looked up together,
        each as the set of its known words.
        """
        starts = [self.starts(len(t)) for t in texts]
        starts = starts if most is None else [s[s < most] for s in starts]
        text_of_passage = np.repeat(np.arange(len(texts)), [len(s) for s in starts])
        start = np.concatenate(starts)
        lengths = np.array([len(t) for t in texts], "i8")
        size = np.minimum(self.window, lengths[text_of_passage] - start)
        offset = np.concatenate([[0], np.cumsum(lengths)])[text_of_passage] + start
        passage = np.repeat(np.arange(len(start)), size)
        inside = np.arange(len(passage)) - np.repeat(np.cumsum(size) - size, size)
        word = np.concatenate(texts)[np.repeat(offset, size) + inside]
        known = word >= 0
        pairs = np.unique(passage[known] * len(self.word_ids) + word[known])
        if not len(pairs):
            return []
        passage, word = np.divmod(pairs, len(self.word_ids))
        row, edges = np.unique(passage, return_index=True)
        alive = np.add.reduceat(self.block_best[word], edges, axis=0) >= self.block_least
        place = np.repeat(np.arange(len(row)), np.diff(np.append(edges, len(passage))))
        some = alive.any(1)[place]
        place, word = place[some], word[some]
        counts = self.first[word + 1] - self.first[word]
        entry = np.repeat(self.first[word], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        place, item = np.repeat(place, counts), self.item_of[entry]
        scored = alive[place, item // self.block_items]
        keys, back = np.unique(place[scored] * len(self.keys) + item[scored], return_inverse=True)
        scores = np.bincount(back, self.worth_of[entry[scored]], len(keys))
        place, item = np.divmod(keys, len(self.keys))
        hit = np.flatnonzero(scores >= self.least[item]) if len(keys) else []
        return [
            (int(text_of_passage[row[place[k]]]), int(start[row[place[k]]]), int(item[k]), float(scores[k])) for k in hit
        ]

    def verified(self, item: int, words: list[str]) -> tuple[float, float] | None:
        """Overlaps of the item's question and answer with ``words``, if both suffice."""
        overlaps = []
        for lengths, part in self.needed[item]:
            found = set()
            for width in lengths:
                found |= part & set(zip(*(words[k:] for k in range(width))))
            overlaps.append(len(found) / len(part))
        if not overlaps or min(overlaps) < OVERLAP:
            return None
        return overlaps[0], overlaps[-1]

    def matches(self, texts: list[str]) -> list[dict[int, tuple[float, float, float]]]:
        """Per text: item -> (largest share of its full score, question overlap, answer overlap)."""
        out: list[dict[int, tuple[float, float, float]]] = [{} for _ in texts]
        get = self.word_ids.get
        # A piece holds whole steps, so passages start at the same words however a text is cut.
        most = self.step * max(1, max(4096, GATHERED // self.blocks) // self.step)
        held: list[tuple[int, list[str], np.ndarray]] = []
        size = 0
        for k, text in enumerate(texts):
            words = words_of(text)
            if not words or not self.keys:
                continue
            # A very long text is looked up in pieces that overlap by a passage.
            for first in range(0, max(1, len(words) - self.longest // 2), most):
                piece = words[first : first + most + self.window]
                held.append((k, piece, np.array([get(w, -1) for w in piece], "i8")))
                size += len(piece)
                if size >= most:
                    self._match(held, out, most)
                    held, size = [], 0
        if held:
            self._match(held, out, most)
        return out

    def _match(self, held: list[tuple[int, list[str], np.ndarray]], out: list[dict], most: int) -> None:
        for piece, start, item, score in self.retrieve([ids for _, _, ids in held], most):
            text, words, _ = held[piece]
            share = score / float(self.full[item])
            if item in out[text] and out[text][item][0] >= share:
                continue
            overlaps = self.verified(item, words[start : start + self.window])
            if overlaps:
                out[text][item] = (share, *overlaps)


def _indexes(benchmark: DataFrame, item_column: str, text_column: str) -> Iterator[Index]:
    """Indexes of at most ``INDEX_ITEMS`` items in key order, all with the statistics of the whole benchmark."""
    items = materialize(
        benchmark.select(
            F.col(item_column).alias("k"), text_of(text_column).alias("t"), F.monotonically_increasing_id().alias("row")
        ),
        "items",
    )

    def counted(columns):
        found = [(row, words_of(text)) for row, text in zip(columns["row"], columns["t"])]
        return {"row": [r for r, _ in found], "length": [len(w) for _, w in found], "words": [sorted(set(w)) for _, w in found]}

    counts = materialize(
        map_rows(items.select("row", "t"), counted, "row bigint, length int, words array<string>").where("length > 0"),
        "item-words",
    )
    one = counts.agg(F.count("*"), F.sum("length"), F.max("length")).first()
    if not one[0]:
        return
    totals = Totals(*map(int, one))
    # Each item brings the counts of its own words along, so a slice needs no list of all words.
    words = counts.select("row", F.explode("words").alias("word"))
    seen = words.groupBy("word").agg(F.count("*").alias("n"))
    of_item = words.join(seen, "word").groupBy("row").agg(F.collect_list(F.struct("word", "n")).alias("seen"))
    rows = items.join(of_item, "row").select("k", "t", "seen").orderBy("k", "t")
    held, appears = [], {}
    for row in rows.toLocalIterator():
        held.append((row.k, row.t))
        appears.update(row.seen)
        if len(held) == INDEX_ITEMS:
            yield Index(held, totals=totals, appears=appears)
            held, appears = [], {}
    if held:
        yield Index(held, totals=totals, appears=appears)


def find_leaks(
    df: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``id, item_id, bm25_share, question_overlap, answer_overlap`` per leaked item of each row."""
    kind, item_kind = (d.schema[c].dataType.simpleString() for d, c in ((df, id_column), (benchmark, item_column)))
    schema = (
        f"`{id_column}` {kind}, item_id {item_kind}, bm25_share double, question_overlap double, answer_overlap double"
    )
    rows, out = df.select(id_column, text_of(text_column).alias("text")), None
    for built in _indexes(benchmark, item_column, item_text):
        index = shared(df.sparkSession, built)

        def run(columns, index=index):
            held = index()
            found = [
                (key, held.keys[item], *measures)
                for key, matched in zip(columns[id_column], held.matches(columns["text"]))
                for item, measures in sorted(matched.items())
            ]
            names = (id_column, "item_id", "bm25_share", "question_overlap", "answer_overlap")
            return {n: [f[k] for f in found] for k, n in enumerate(names)}

        part = map_rows(rows, run, schema, rows=LOOKUP_ROWS)
        out = part if out is None else out.unionByName(part)
    return df.sparkSession.createDataFrame([], schema) if out is None else out


def remove_leaks(
    df: DataFrame, benchmark: DataFrame, text_column: str = "text", item_column: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The rows of ``df`` without a leaked item, with all their columns, without a shuffle."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    for built in _indexes(benchmark, item_column, item_text):
        index = shared(df.sparkSession, built)

        def run(columns, index=index):
            held = index()
            matched = held.matches([t or "" for t in columns[text_column]])
            keep = [k for k, found in enumerate(matched) if not found]
            return {n: [c[k] for k in keep] for n, c in columns.items()}

        df = map_rows(df, run, schema, rows=LOOKUP_ROWS)
    return df


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that documents contain."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
