"""Language-model scores by online logistic context mixing.

A token is coded as a path of bits: words that training texts use most have Huffman codes, all
others share one leaf and are told apart there by their unigram weights. Each bit is predicted
from the node it leaves together with several hashed contexts: none, the token before, the two
before, and the one before last, from counts over all training texts, and from what the document
itself has shown so far. A gated mixer adds the predictions in the logistic domain;
its weights are chosen by depth and by how often the longest context was seen, and they are
refined every ``STEPS`` tokens of the document, starting from weights fitted on training texts.

So the model spreads one unit of probability over the training vocabulary and one class of
unknown words, the same events as the unigram base.

* Word counts are exact. Documents are dealt into blocks by a hash of id and text; a block's distinct
  words are counted, and a window over each word's blocks gives every block the sums of its words.
* Context counts live in tables of fixed size. Every task adds up its own, and the tables are
  merged chunk by chunk in levels of bounded fan-in.
* What is broadcast has a fixed bound: ``TOP_WORDS`` words, the tables, the weights.
* The mixer's first weights are fitted on all training texts; every task refines its own, the mean by tokens stays.

A document's score depends on the model and its own text only, not on its block.

Defined cases: null text is empty and has the end token alone; a null id counts as empty text
when folds are dealt; repeated rows are scored, and learned from, each; without training texts
every token is unknown and costs nothing; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.llm.common import shared, table, text_of
from orderloom.session import materialize

TOP_WORDS = 4095
TABLE_BITS = 19
CONTEXTS = 3
CHUNK_SLOTS = 1 << 16
FAN_IN = 64
BLOCK_BYTES = 32_000_000
# So many powers a process keeps for the hashes of words; longer texts make their own.
KEPT_POWERS = 1 << 20
# Bytes of texts that are cut into words in one go.
PIECE_BYTES = 1 << 20
LANES = 128
OWN_SLOTS = 4096
STEPS = 24
# Tokens whose inputs are prepared in one go; their arrays stay in a core's cache.
INPUT_TOKENS = 1 << 13
# Bytes of texts looked up, and tokens counted, in one go.
COUNT_BYTES = 1 << 16
COUNT_TOKENS = 1 << 13
RATE = 0.015
FIT_RATE = 0.004
OTHER_CONTEXTS = 1 << 18
# Up to so many events the sums for all inputs are taken in one call.
FEW_EVENTS = 1 << 12
DEPTHS, SEEN = 8, 4
INPUTS = CONTEXTS + 3
END = b""
_MASK = (1 << TABLE_BITS) - 1
_LIMIT = 8.0
_ONCE = np.float32(1)


def tokens(text: str) -> list[bytes]:
    """Lower-cased words between ASCII white space, and the end."""
    return [*text.encode().lower().split(), END]


def raw(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """Texts as they lie in Arrow, in UTF-8, without a way through strings."""
    return column.cast(pa.binary()).to_pylist()


def held_out(id_column: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % 5 == 1


@dataclass
class Code:
    """Huffman codes of the common words and of the leaf that stands for all others."""

    number: dict[bytes, int]
    first: np.ndarray  # token number -> where its path starts
    nodes: np.ndarray  # of all paths, one after another
    bits: np.ndarray
    depth: np.ndarray
    ahead: np.ndarray  # node -> stretched chance of a one


def build_code(common: list[tuple[bytes, int]], rest: float) -> Code:
    weights = [c + 0.5 for _, c in common] + [max(rest, 0.5)]
    heap = [(w, k, None) for k, w in enumerate(weights)]
    heapq.heapify(heap)
    made = len(weights)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        heapq.heappush(heap, (a[0] + b[0], made, (a, b)))
        made += 1
    paths: list[list[tuple[int, int]]] = [[] for _ in weights]
    chances, waiting = [], [(heap[0], [])]
    while waiting:
        (_, k, pair), path = waiting.pop()
        if pair is None:
            paths[k] = path
            continue
        node = len(chances)
        chances.append(pair[1][0] / (pair[0][0] + pair[1][0]))
        waiting += [(pair[0], [*path, (node, 0)]), (pair[1], [*path, (node, 1)])]
    flat = [(n, b, d) for p in paths for d, (n, b) in enumerate(p)]
    nodes, bits, depth = np.array(flat, "i4").reshape(-1, 3).T
    p = np.clip(np.array(chances or [0.5]), 1e-9, 1 - 1e-9)
    return Code(
        {w: k for k, (w, _) in enumerate(common)}, np.cumsum([0, *map(len, paths)]), nodes.astype("i8"),
        bits.astype("i1"), np.minimum(depth, DEPTHS - 1).astype("i8"), np.log(p / (1 - p)),
    )


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def bounds(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which bytes are in words between ASCII white space, and where words start and end."""
    inside = np.zeros(len(letters) + 2, bool)
    np.logical_and(letters != 32, letters - np.uint8(9) > 4, out=inside[1:-1])  # nine to thirteen, the rest wraps or is above
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return inside[1:-1], edges[::2], edges[1::2]


def spelled(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and 64-bit hashes of the words between ASCII white space, in order.

    The hash is a polynomial of the word's bytes, taken from running sums over all bytes, so no
    word is made an object of its own.
    """
    letters = np.frombuffer(data, "u1")
    _, starts, ends = bounds(letters)
    return starts, hashes_of(letters, starts, ends)


def hashes_of(letters: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    powers, back = _kept_powers() if len(letters) <= KEPT_POWERS else _powers(len(letters))
    sums = np.zeros(len(letters) + 1, "u8")
    terms = letters.astype("u8")
    terms += np.uint64(1)
    terms *= powers[: len(letters)]
    np.cumsum(terms, out=sums[1:])
    return _mixed((sums[ends] - sums[starts]) * back[starts])


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.cumprod(np.full(n, base, "u8"), dtype="u8") for base in (_BASE, _INVERSE))


@lru_cache(1)
def _kept_powers() -> tuple[np.ndarray, np.ndarray]:
    return _powers(KEPT_POWERS)


def spell_out(texts: list[bytes]) -> tuple[pa.ChunkedArray, np.ndarray]:
    """``tokens`` of all texts in order as they lie in Arrow, and how many each text has."""
    pieces, lengths, first = [], [np.zeros(0, "i8")], 0
    sizes = np.cumsum([len(t) + 1 for t in texts])
    while first < len(texts):
        last = int(np.searchsorted(sizes, (sizes[first - 1] if first else 0) + PIECE_BYTES)) + 1
        part = texts[first:last]
        letters = np.frombuffer(b" ".join(part).lower(), "u1")
        inside, starts, ends = bounds(letters)
        words = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in part]))
        edges = np.cumsum(np.insert(ends - starts, [0, *words], 0)).astype("i4")  # the end is a word of no letters
        pieces.append(pa.BinaryArray.from_buffers(
            pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(letters[inside])]
        ))
        lengths.append(np.diff(words, prepend=0) + 1)
        first = last
    return pa.chunked_array(pieces, pa.binary()), np.concatenate(lengths)


def distinct_words(words: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The distinct words, and per word its place among them."""
    chunks = words.dictionary_encode().chunks
    if not chunks:
        return pa.array([], pa.binary()), np.zeros(0, "i4")
    return chunks[-1].dictionary, np.concatenate([c.indices.to_numpy() for c in chunks])


def spread_contexts(hashes: np.ndarray, other: int) -> np.ndarray:
    return (hashes % np.uint64(OTHER_CONTEXTS)).astype("i8") + other + 1


class HashedWords:
    """Token and context numbers of whole texts at once, for counting, where no word is looked up by itself."""

    def __init__(self, code: Code):
        words = [w for w in code.number if w != END]
        _, hashes = spelled(b" ".join(words))
        order = np.argsort(hashes)
        self.other, self.end = len(code.number), code.number.get(END, len(code.number))
        self.hashes, self.numbers = hashes[order], np.array([code.number[w] for w in words], "i8")[order]
        # Where hashes with the same first 16 bits begin, and how many there are at most.
        self.begin = np.searchsorted(self.hashes >> np.uint64(48), np.arange(1 << 16, dtype="u8")).astype("i4")
        self.most = int(np.diff(self.begin, append=len(words)).max())

    def look(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Rows (token number, context number) of the texts' tokens, each with its end, and their lengths."""
        starts, hashes = spelled(b" ".join(texts))
        edges = np.cumsum([len(t) + 1 for t in texts])
        words = np.diff(np.searchsorted(starts, edges), prepend=0)
        number, spread = np.full(len(starts), self.other, "i8"), spread_contexts(hashes, self.other)
        begin = self.begin.take(hashes >> np.uint64(48))
        for k in range(self.most):
            at = np.minimum(begin + k, len(self.hashes) - 1)
            found = np.flatnonzero(self.hashes.take(at) == hashes)
            number[found] = self.numbers.take(at.take(found))
        ends = np.cumsum(words)
        context = np.insert(np.where(number < self.other, number, spread), ends, self._end_context())
        return np.stack([np.insert(number, ends, self.end), context], 1), words + 1

    def _end_context(self) -> int:
        return self.end if self.end < self.other else self.other + 1


class Words:
    """What is known of words: token number, context number, training count.

    Words outside the code share a token number; a hash tells them apart as contexts. ``known`` are
    words (``word``), each once, and their counts (``c``); all others count as never met.
    """

    def __init__(self, code: Code, known: pa.Table | None = None):
        self.code, self.known = code, known

    def look(self, words: list[bytes]) -> np.ndarray:
        """Rows (token number, context number, count), one per word."""
        met, ids = distinct_words(pa.chunked_array([pa.array(words, pa.binary())]))
        return self.facts(met)[ids]

    def facts(self, met: pa.Array) -> np.ndarray:
        """``look`` for words that are not repeated."""
        other = len(self.code.number)
        number = _places(met, pa.array(list(self.code.number), pa.binary()), other)
        context = np.full(len(met), other + 1)
        edges, letters = _buffers(met)
        for start in range(0, len(met), 1 << 14):
            part = edges[start : start + (1 << 14) + 1]
            filled = np.flatnonzero(part[1:] > part[:-1])
            hashes = hashes_of(letters[part[0] : part[-1]], part[filled] - part[0], part[filled + 1] - part[0])
            context[start + filled] = spread_contexts(hashes, other)
        count = np.zeros(len(met), "i8")
        if self.known is not None:
            c = np.append(self.known["c"].to_numpy(), 0)
            count = c[_places(met, self.known["word"].combine_chunks().cast(pa.binary()), -1)]
        return np.stack([number, np.where(number < other, number, context), count], 1)


def _buffers(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Edges of the words, and the letters they are edges in."""
    _, edges, letters = words.buffers()
    if not len(words):
        return np.zeros(1, "i4"), np.zeros(0, "u1")
    return (
        np.frombuffer(edges, "i4")[words.offset : words.offset + len(words) + 1],
        np.frombuffer(letters, "u1") if letters is not None and letters.size else np.zeros(0, "u1"),
    )


def _places(words: pa.Array, among: pa.Array, missing: int) -> np.ndarray:
    return pc.index_in(words, value_set=among).fill_null(missing).to_numpy().astype("i8")


_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(value: np.ndarray) -> np.ndarray:
    value = value * _SPREAD
    return value ^ (value >> np.uint64(29))


def contexts(context: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Per token of texts laid end to end the hashes of the token before, the two before, and the one before last."""
    one = np.concatenate([[0], context[:-1] + 1]).astype("u8")
    two = np.concatenate([[0, 0], context[:-2] + 1])[: len(context)].astype("u8")
    starts = np.cumsum(lengths) - lengths
    one[starts] = two[starts] = 0
    two[(starts + 1)[lengths > 1]] = 0
    return np.stack([_mixed(one + np.uint64(1 << 40)), _mixed(_mixed(one) + two), _mixed(two + np.uint64(1 << 41))])


def raised(nodes: np.ndarray) -> np.ndarray:
    """What ``slots`` adds to the upper halves of context hashes: a node counts from bit 32 up, spread like the hash."""
    return nodes.astype("u4") * np.uint32(_SPREAD & np.uint64(0xFFFFFFFF))


def slots(spread: np.ndarray, token: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Per event the 20th and further bits of h ^ (h >> 29), where h is its token's context hash and its node, both spread.

    Hashes are spread once per token; a node changes the upper half only, so halves are enough.
    """
    parts = spread.take(token).view("u4")
    upper = parts[1::2] + high
    out = upper << np.uint32(12)
    out ^= parts[::2] >> np.uint32(20)
    upper >>= np.uint32(17)
    out ^= upper
    out &= np.uint32(_MASK)
    return out


def events(code: Code, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the bits of all tokens in order: how many each token has, which token each is of, and their places in the paths."""
    sizes = code.first[number + 1] - code.first[number]
    token = np.repeat(np.arange(len(number)), sizes)
    place = (code.first[number] - (np.cumsum(sizes) - sizes)).take(token)
    place += np.arange(len(token))
    return sizes, token, place


# --- counting contexts ----------------------------------------------------------------------


def _count_contexts(code) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts, own = code(), np.zeros((CONTEXTS, 2 << TABLE_BITS), "u4"), 0
        words, nodes = HashedWords(held), raised(held.nodes)
        mark = held.bits.astype("u4")

        def add(texts: list[bytes]) -> int:
            seen, lengths = words.look(texts)
            hashes = contexts(seen[:, 1], lengths) * _SPREAD
            for start in range(0, len(seen), COUNT_TOKENS):
                piece = slice(start, start + COUNT_TOKENS)
                _, token, place = events(held, seen[piece, 0])
                high, bit = nodes.take(place), mark.take(place)
                for k in range(CONTEXTS):
                    at = slots(hashes[k, piece], token, high)
                    at <<= np.uint32(1)
                    at |= bit
                    np.add.at(counts[k], at.astype("i8"), np.uint32(1))
            return len(seen)

        waiting, size = [], 0
        for batch in batches:
            for text in raw(batch.column("text")):
                waiting.append(text.lower())
                size += len(waiting[-1])
                if size > COUNT_BYTES:
                    own += add(waiting)
                    waiting, size = [], 0
        if waiting:
            own += add(waiting)
        if own:
            pack = zstandard.ZstdCompressor(level=1).compress
            chunks = [pack(c.tobytes()) for c in counts.reshape(-1, 2 * CHUNK_SLOTS)]
            salt = int(np.random.default_rng(own).integers(1 << 30))
            yield pa.RecordBatch.from_pydict(
                {"chunk": pa.array(range(len(chunks)), pa.int32()), "salt": pa.array([salt] * len(chunks), pa.int32()), "part": chunks}
            )

    return run


def _merge_chunk(t: pa.Table) -> pa.Table:
    unpack = zstandard.ZstdDecompressor().decompress
    total = np.zeros(2 * CHUNK_SLOTS, "u4")
    for part in t["part"]:
        new = total + np.frombuffer(unpack(part.as_py()), "u4")
        total = np.where(new < total, np.uint32(0xFFFFFFFF), new)
    pack = zstandard.ZstdCompressor(level=1).compress
    return pa.table({"chunk": t["chunk"].slice(0, 1), "salt": t["salt"].slice(0, 1), "part": [pack(total.tobytes())]})


def context_tables(texts: DataFrame, code) -> np.ndarray:
    """Counts of zeros and ones per context slot: contexts x slots x 2."""
    schema = "chunk int, salt int, part binary"
    parts = materialize(texts.mapInArrow(_count_contexts(code), schema), "context-counts")
    chunks = (CONTEXTS << TABLE_BITS) // CHUNK_SLOTS
    fan = parts.count() // chunks
    while fan > 1:
        fan = -(-fan // FAN_IN)
        salted = parts.withColumn("salt", F.pmod("salt", F.lit(fan)).cast("int"))
        parts = materialize(salted.groupBy("chunk", "salt").applyInArrow(_merge_chunk, schema), "context-merge")
    out = np.zeros((chunks, 2 * CHUNK_SLOTS), "u4")
    for row in parts.collect():  # a fixed number of chunks
        out[row.chunk] = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(row.part)), "u4")
    return out.reshape(CONTEXTS, 1 << TABLE_BITS, 2)


# --- mixing ---------------------------------------------------------------------------------


@dataclass
class Mixer:
    code: Code
    tables: np.ndarray
    weights: np.ndarray  # gate, input

    def __getstate__(self) -> dict:
        """What is derived below is made where it is needed, not sent."""
        return {"code": self.code, "tables": self.tables, "weights": self.weights}

    @cached_property
    def paths(self) -> tuple[np.ndarray, ...]:
        """By place in the paths: stretched chance of a one and the chance as one 64-bit number, node, first gate and bit as one."""
        code = self.code
        odds = np.exp(code.ahead)
        chances = np.stack([np.clip(code.ahead, -_LIMIT, _LIMIT), odds / (1 + odds)], 1).astype("f4")
        return chances.view("c8")[code.nodes, 0], code.nodes.astype("i4"), (code.depth * SEEN * 2 + code.bits).astype("i2")

    def own_counts(self, lanes: int) -> np.ndarray:
        """Room for what texts have shown, the same each time, cleared."""
        size = lanes * OWN_SLOTS * 2
        if len(self.__dict__.get("room", ())) < size:
            self.room = np.empty(size, "f4")
        own = self.room[:size]
        own.fill(0)
        return own

    @cached_property
    def pairs(self) -> list[np.ndarray]:
        """Both counts of a slot as one 64-bit number, so that they are fetched at once."""
        return [np.ascontiguousarray(t, "f4").view("c8")[:, 0] for t in self.tables]

    def bits_of(
        self, seen: np.ndarray, lengths: np.ndarray, rate: float, leave_out: bool = False, common: bool = False
    ) -> np.ndarray:
        """Bits per text, from the token and context numbers of texts laid end to end.

        ``leave_out`` takes each event out of the counts that predict it, for texts that were
        counted. ``common`` refines one set of weights over all texts and keeps it, instead of
        one per text.
        """
        out = np.zeros(len(lengths))
        self._run(seen, lengths, rate, leave_out, common, out)
        return out

    def refine(self, seen: np.ndarray, lengths: np.ndarray, rate: float) -> None:
        """``bits_of`` counted texts under common weights, of which the weights are all that is asked for."""
        self._run(seen, lengths, rate, True, True, None)

    def _run(self, seen, lengths, rate, leave_out, common, out):
        hashes, starts = contexts(seen[:, 1], lengths) * _SPREAD, np.cumsum(lengths) - lengths
        order, number = np.argsort(-lengths, kind="stable"), np.ascontiguousarray(seen[:, 0])
        for first in range(0, len(order), LANES):
            lanes = order[first : first + LANES]
            bits = None if out is None else np.zeros(len(lanes))
            self._lanes(number, hashes, starts[lanes], lengths[lanes], rate, leave_out, common, bits)
            if out is not None:
                out[lanes] = bits / np.log(2)

    def _lanes(self, number, hashes, starts, lengths, rate, leave_out, common, bits):
        count, gates = len(lengths), DEPTHS * SEEN
        weights = np.tile(self.weights.T, 1 if common else count).astype("f4")  # input, lane and gate
        own = self.own_counts(count)
        pairs = own.view("c8")
        # Tokens in the order they are coded in: by step, then by lane. Inputs are prepared for several steps at once.
        lane = np.repeat(np.arange(count), lengths)
        at = np.arange(len(lane)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        order = np.argsort(at // STEPS, kind="stable")
        spot, lane = (np.repeat(starts, lengths) + at)[order], lane[order]
        edges = np.concatenate([[0], np.cumsum(np.bincount(at // STEPS))])
        first, steps = 0, len(edges) - 1
        while first < steps:
            last = max(first + 1, int(np.searchsorted(edges, edges[first] + INPUT_TOKENS, "right")) - 1)
            piece = slice(edges[first], edges[last])
            sizes, token, place = events(self.code, number.take(spot[piece]))
            on = lane[piece].take(token)
            x, one, bit, gate, node = self._inputs(hashes.take(spot[piece], axis=1), token, place, leave_out)
            mine = on * OWN_SLOTS
            mine += node & (OWN_SLOTS - 1)
            gate = gate.astype("i8") if common else gate + on * gates
            sign = 2 * bit.astype("f4") - 1
            facts = (one + one, 2 * (1 - one), -sign, np.float32(rate) * sign, gate, mine, mine * 2 + bit, on)
            ends = np.concatenate([[0], np.cumsum(sizes)])[edges[first : last + 1] - edges[first]].tolist()
            for here in map(slice, ends, ends[1:]):
                if here.start < here.stop:
                    reach = gates if common else (int(on[here.stop - 1]) + 1) * gates
                    self._step(weights, own, pairs, bits, x[:, here], *(values[here] for values in facts), reach)
            first = last
        if common:
            self.weights = weights.T.astype("f8")

    def _inputs(self, hashes, token, place, leave_out):
        """By event the inputs that do not depend on what the text has shown so far, and what the paths and counts tell.

        Every input is the log of chances: counts pull the order-0 chance to what was shown.
        """
        chances, node, gate = (values.take(place) for values in self.paths)
        bit = (gate & 1).astype("i1")
        gate >>= 1
        high, one = raised(node), np.ascontiguousarray(chances.view("f4")[1::2])
        x = np.empty((INPUTS, len(place)), "f4")
        x[0], x[-1] = chances.view("f4")[::2], 0.3
        pull_one, pull_zero = 0.7 * one, 0.7 * (1 - one)
        if leave_out:
            is_zero, is_one = (1 - bit).astype("f4"), bit.astype("f8")  # in double, so that large counts are told apart
        for k in range(CONTEXTS):
            n = self.pairs[k].take(slots(hashes[k], token, high)).view("f4")
            zeros, ones = n[::2], n[1::2]
            if leave_out:
                zeros, ones = zeros - is_zero, ones - is_one
                np.maximum(zeros, 0, out=zeros)
                np.maximum(ones, 0, out=ones)
            if k == 1:
                total = zeros + ones
                gate += (total > 0.5).view("i1") + (total > 1.5).view("i1") + (total > 6.5).view("i1")
            np.log((ones + pull_one) / (zeros + pull_zero), out=x[1 + k])
        np.clip(x[1:-2], -_LIMIT, _LIMIT, out=x[1:-2])
        return x, one, bit, gate, node

    def _step(self, weights, own, pairs, bits, x, one, zero, flip, pace, gate, mine, shown, on, reach):
        """Bits of one step's events, and what they teach: weights and own counts stand still within a step."""
        n = pairs.take(mine).view("f4")
        ratio = np.add(n[1::2], one, out=x[-2])
        ratio /= n[::2] + zero
        np.log(ratio, out=ratio)
        np.maximum(ratio, -_LIMIT, out=ratio)
        np.minimum(ratio, _LIMIT, out=ratio)
        products = weights.take(gate, axis=1)
        products *= x
        mixed = np.add.reduce(products, 0)
        mixed *= flip
        np.maximum(mixed, -20, out=mixed)
        np.minimum(mixed, 20, out=mixed)
        missed = mixed.astype("f8")
        np.exp(missed, out=missed)
        whole = 1 + missed
        if bits is not None:
            told = np.bincount(on, np.log(whole))
            bits[: len(told)] += told
        missed /= whole
        missed *= pace
        np.multiply(x, missed.astype("f4"), out=products)
        if len(gate) > FEW_EVENTS:
            for k in range(INPUTS):
                weights[k, :reach] += np.bincount(gate, products[k], reach).astype("f4")
        else:
            bins = np.add.outer(np.arange(0, INPUTS * reach, reach), gate).ravel()
            weights[:, :reach] += np.bincount(bins, products.ravel(), INPUTS * reach).astype("f4").reshape(INPUTS, reach)
        np.add.at(own, shown, _ONCE)


def first_weights() -> np.ndarray:
    out = np.zeros((DEPTHS * SEEN, INPUTS))
    out[:, 0] = 0.7
    out[:, 1 : 1 + CONTEXTS] = 0.1
    return out


def _fit_weights(model) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, tables = model()
        mixer, words, n = Mixer(code, tables, first_weights()), HashedWords(code), 0
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                seen, lengths = words.look([t.lower() for t in raw(batch.column("text").slice(start, 64))])
                mixer.refine(seen, lengths, FIT_RATE)
                n += int(lengths.sum())
        if n:
            yield pa.RecordBatch.from_pydict({"weights": [mixer.weights.tobytes()], "n": [n]})

    return run


def mixer_weights(texts: DataFrame, model) -> np.ndarray:
    """Every task refines the same first weights on its texts; the mean by tokens stays."""
    rows = texts.mapInArrow(_fit_weights(model), "weights binary, n bigint").collect()
    if not rows:
        return first_weights()
    total = sum(r.n for r in rows)
    return sum(np.frombuffer(bytes(r.weights)).reshape(DEPTHS * SEEN, INPUTS) * (r.n / total) for r in rows)


# --- corpus ---------------------------------------------------------------------------------


def _block_words(t: pa.Table) -> pa.Table:
    """The distinct words of a block with their number in training texts."""
    words, lengths = spell_out(raw(t["text"]))
    met, ids = distinct_words(words)
    counted = np.repeat(~np.array(t["held_out"].to_pylist(), bool), lengths)
    return pa.table({
        "block": pa.array(np.full(len(met), t["block"][0].as_py(), "i4")),
        "word": met,
        "n": pa.array(np.bincount(ids[counted], minlength=len(met))),
    })


def _score_block(model, total: int, distinct: int, id_name: str, id_type) -> callable:
    unit = total + 0.5 * (distinct + 1)
    empty = [
        (id_name, id_type), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
        ("base_score", pa.float64()), ("score", pa.float64()), ("bits_per_byte", pa.float64()),
    ]

    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return pa.table({n: pa.array([], t) for n, t in empty})
        mixer, rare = model()
        data = raw(docs["text"])
        words, lengths = spell_out(data)
        met, ids = distinct_words(words)
        size = np.array([len(t) + 1 for t in data])
        del data, words
        facts = Words(mixer.code, known).facts(met)
        c = facts[:, 2]
        # Words of the shared leaf: their weight among all that share it.
        shared_leaf = np.where(facts[:, 0] == len(mixer.code.number), np.log10((c + 0.5) / rare), 0.0)
        weight, is_known = np.log10((c + 0.5) / unit), (c > 0).astype("i8")
        starts = np.cumsum(lengths) - lengths
        n_known, base, score = np.zeros(len(lengths), "i8"), np.zeros(len(lengths)), np.zeros(len(lengths))
        order = np.argsort(-lengths, kind="stable")  # texts of near lengths end together
        for first in range(0, len(order), LANES):
            lanes = order[first : first + LANES]
            some = lengths[lanes]
            edges = np.cumsum(some) - some
            held = ids[np.repeat(starts[lanes] - edges, some) + np.arange(some.sum())]
            bits = mixer.bits_of(facts[held], some, RATE)
            n_known[lanes] = np.add.reduceat(is_known[held], edges)
            base[lanes] = np.add.reduceat(weight[held], edges)
            score[lanes] = np.add.reduceat(shared_leaf[held], edges) - bits * np.log10(2)
        return pa.table({
            id_name: docs[id_name].cast(id_type),
            "held_out": docs["held_out"],
            "n_tokens": lengths,
            "n_known": n_known,
            "base_score": base,
            "score": np.minimum(score, 0.0),
            "bits_per_byte": np.maximum(-score, 0.0) / np.log10(2) / size,
        })

    return run


def score_texts(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row the log10 probability of its text under the mixed model and under the unigram base."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark = df.sparkSession
    rows = df.select(id_column, text_of(text_column).alias("text")).withColumn("held_out", held_out(id_column))
    kind = rows.schema[id_column].dataType
    size = rows.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64(id_column, "text"), F.lit(blocks)).cast("int"))
    words = dealt.groupBy("block").applyInArrow(_block_words, "block int, word binary, n bigint")
    # One shuffle by word both sums the counts of its blocks and gives each of them the sum.
    blocks_of = Window.partitionBy("word")
    known = materialize(
        words.select(
            "block", "word", F.sum("n").over(blocks_of).alias("c"),
            (F.min("block").over(blocks_of) == F.col("block")).alias("once"),
        ).where("c > 0"), "word-counts",
    )
    counts = known.where("once")
    summed = counts.agg(F.count("*").alias("v"), F.sum("c").alias("n")).first()
    distinct, total = summed.v, summed.n or 0
    top = counts.orderBy(F.desc("c"), "word").limit(TOP_WORDS).collect()
    common = [(bytes(r.word), r.c) for r in top]
    # The shared leaf holds the other known words and the class of unknown ones.
    rare = total + 0.5 * (distinct + 1) - sum(c + 0.5 for _, c in common)
    code = build_code(common, rare)
    sent = shared(spark, code)
    training = rows.where(~F.col("held_out")).select("text")
    tables = context_tables(training, sent).astype("f4")  # as the mixer reads them, so that no task holds a copy
    weights = mixer_weights(training, shared(spark, (code, tables)))
    model = shared(spark, (Mixer(code, tables, weights), rare))
    schema = (
        f"`{id_column}` {kind.simpleString()}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, "
        "score double, bits_per_byte double"
    )
    scored = dealt.groupBy("block").cogroup(known.select("block", "word", "c").groupBy("block")).applyInArrow(
        _score_block(model, total, distinct, id_column, to_arrow_type(kind)), schema
    )
    return scored.withColumn("train_tokens", F.lit(total).cast("bigint"))


def op5_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"
    )
