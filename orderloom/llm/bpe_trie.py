"""BPE encoding by a prefix-sharing trie, and decoding.

In a BPE encoding only neighbours matter: a sequence of tokens is the encoding of its text
exactly when every two neighbours, put together and encoded alone, stay those two tokens. So
the encoding of each prefix is known from its last token, and the last token of a prefix
follows from the last tokens of shorter ones. Distinct words are inserted into a trie; the walk
goes depth first, keeps one last token per depth, and so computes a shared prefix once.

Each task builds the trie of the words it meets first; results are remembered up to a fixed
number of words, and forgotten together when there are more. Nothing is shuffled.

Defined cases: null text is empty and has no ids; very long texts are encoded whole, in one task; a null
id is allowed; a repeated row is encoded like any other; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import struct

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import bytelevel
from orderloom.llm.common import map_rows, shared, table, text_of

MEMORY_WORDS = 600_000
_NO_LIMIT = 1 << 60


class TrieEncoder:
    def __init__(self, vocabulary: bytelevel.Vocabulary, memory_words: int = MEMORY_WORDS):
        self.vocabulary = vocabulary
        self.memory_words = memory_words
        self.split = bytelevel.splitter(vocabulary.special)
        self.special = {s: struct.pack("<I", n) for s, n in vocabulary.special.items()}
        self.alone = {b: n for b, n in vocabulary.id_of.items()}
        self.lengths: dict[bytes, tuple[int, ...]] = {}
        found: dict[bytes, set[int]] = {}
        for token in self.alone:
            if len(token) > 1:
                found.setdefault(token[-2:], set()).add(len(token))
        self.lengths = {end: tuple(sorted(n, reverse=True)) for end, n in found.items()}
        self.parts = {made: (pair, rank) for pair, (rank, made) in vocabulary.merge.items()}
        self.spines: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        size = max(vocabulary.bytes_of) + 1
        self.bytes_by_id = [vocabulary.bytes_of.get(k, b"") for k in range(size)]

    def spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """From the outermost byte up to ``token``: each part with the rank that merges it away."""
        known = self.spines.get((token, side))
        if known is None:
            chain, until = [], _NO_LIMIT
            while True:
                chain.append((token, until))
                if token not in self.parts:
                    break
                pair, until = self.parts[token]
                token = pair[side]
            known = self.spines[(chain[0][0], side)] = chain[::-1]
        return known

    def neighbours(self, left: int, right: int) -> bool:
        """Whether the two tokens, as one text, are encoded as just these two.

        Replays the merges that touch the border in order of rank: the border stands unless the
        parts on its two sides can merge before either is merged into its own token.
        """
        known = self.fits.get((left, right))
        if known is None:
            a, b, merge = self.spine(left, 1), self.spine(right, 0), self.vocabulary.merge
            i = j = 0
            known = True
            while True:
                (x, x_until), (y, y_until) = a[i], b[j]
                met = merge.get((x, y))
                if met is not None and met[0] < x_until and met[0] <= y_until:
                    known = False
                    break
                if x_until == y_until == _NO_LIMIT:
                    break
                if x_until <= y_until:
                    i += 1
                else:
                    j += 1
            if len(self.fits) > self.memory_words:
                self.fits.clear()
            self.fits[(left, right)] = known
        return known

    def walk(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Encode distinct words: sorted, they are the trie's leaves in depth-first order."""
        alone, lengths, fits, neighbours = self.alone, self.lengths, self.fits, self.neighbours
        out: dict[bytes, bytes] = {}
        last: list[int] = []  # last[d]: the last token of the first d + 1 bytes of the path
        taken: list[int] = []  # its length
        before = b""
        for word in sorted(words):
            shared_depth, most = 0, min(len(before), len(word), len(last))
            while shared_depth < most and before[shared_depth] == word[shared_depth]:
                shared_depth += 1
            del last[shared_depth:], taken[shared_depth:]
            for end in range(shared_depth + 1, len(word) + 1):
                for size in lengths.get(word[end - 2 : end], ()) if end > 1 else ():
                    if size > end:
                        continue
                    token = alone.get(word[end - size : end])
                    if token is None:
                        continue
                    start = end - size
                    if start:
                        pair = (last[start - 1], token)
                        fit = fits.get(pair)
                        if fit is None:
                            fit = neighbours(*pair)
                        if not fit:
                            continue
                    elif not self.is_whole(token):
                        continue
                    last.append(token)
                    taken.append(size)
                    break
                else:
                    last.append(alone[word[end - 1 : end]])
                    taken.append(1)
            ids, end = [], len(word)
            while end:
                ids.append(last[end - 1])
                end -= taken[end - 1]
            ids.reverse()
            out[word] = struct.pack(f"<{len(ids)}I", *ids)
            before = word
        return out

    def is_whole(self, token: int) -> bool:
        """Whether the token's own text is encoded as this token: its two parts would merge."""
        known = self.fits.get((token, -1))
        if known is None:
            known = self.vocabulary.merged(self.vocabulary.bytes_of[token]) == [token]
            self.fits[(token, -1)] = known
        return known

    def learn(self, new: set[str]) -> None:
        """Remember the ids of ``new`` pieces, whose first character is the space before them."""
        if len(self.pieces) + len(new) > self.memory_words:
            self.pieces.clear()
            self.words.clear()
        split = {p: bytelevel.pre_tokens(p) for p in new}
        words = {w for found in split.values() for w in found}.difference(self.words)
        encoded = {w: w.encode() for w in words}
        found = self.walk(list(encoded.values()))
        self.words.update((w, found[b]) for w, b in encoded.items())
        known = self.words
        self.pieces.update((p[1:], b"".join([known[w] for w in ws])) for p, ws in split.items())

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        cut = [[bytelevel.pieces(part) for part in self.split(t)] for t in texts]
        met = {p for parts in cut for part in parts[::2] for p in part[1:]}
        firsts = {part[0] for parts in cut for part in parts[::2]}
        new = {f" {p}" for p in met.difference(self.pieces)}
        if new:
            if len(self.pieces) + len(new) > self.memory_words:
                new = {f" {p}" for p in met}
            self.learn(new)
        first = {f: bytelevel.pre_tokens(f) for f in firsts}
        missing = {w for ws in first.values() for w in ws}.difference(self.words)
        if missing:
            encoded = {w: w.encode() for w in missing}
            found = self.walk(list(encoded.values()))
            self.words.update((w, found[b]) for w, b in encoded.items())
        out, known = [], self.pieces
        for parts in cut:
            ids = []
            for k, part in enumerate(parts):
                if k % 2:
                    ids.append(self.special["".join(" ".join(part))])
                else:
                    ids += [self.words[w] for w in first[part[0]]]
                    ids += [known[p] for p in part[1:]]
            out.append(b"".join(ids))
        return out

    def decode(self, ids: bytes) -> str:
        table = self.bytes_by_id
        return b"".join([table[n] for n in memoryview(ids).cast("I")]).decode("utf-8", "replace")


_ENCODERS: dict[tuple[str, int], TrieEncoder] = {}


def _encoder(path: str, vocabulary, memory_words: int = MEMORY_WORDS) -> TrieEncoder:
    """One encoder per worker process and memory, whose vocabulary is kept for later tasks."""
    if (path, memory_words) not in _ENCODERS:
        _ENCODERS[(path, memory_words)] = TrieEncoder(vocabulary(), memory_words)
    return _ENCODERS[(path, memory_words)]


def _forget() -> None:
    """The worker process goes on to other tasks, which need the memory."""
    for encoder in _ENCODERS.values():
        encoder.pieces.clear()
        encoder.words.clear()


def encode(
    df: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", memory_words: int = MEMORY_WORDS
) -> DataFrame:
    """``id, n_tokens, ids`` per row; ``ids`` are little-endian unsigned 32-bit integers.

    ``memory_words`` bounds what a process remembers; a smaller number costs time, not results.
    """
    vocabulary = shared(df.sparkSession, bytelevel.Vocabulary(path))
    kind = df.schema[id_column].dataType.simpleString()

    def run(columns):
        ids = _encoder(path, vocabulary, memory_words).encode(columns["text"])
        return {id_column: columns[id_column], "n_tokens": [len(i) // 4 for i in ids], "ids": ids}

    rows = df.select(id_column, text_of(text_column).alias("text"))
    return map_rows(rows, run, f"`{id_column}` {kind}, n_tokens bigint, ids binary", rows=500, after=_forget)


def decode(df: DataFrame, path: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """``id, text`` per row of ids; bytes that are no UTF-8 become the replacement character."""
    vocabulary = shared(df.sparkSession, bytelevel.Vocabulary(path))
    kind = df.schema[id_column].dataType.simpleString()

    def run(columns):
        encoder = _encoder(path, vocabulary)
        return {id_column: columns[id_column], "text": [encoder.decode(i or b"") for i in columns["ids"]]}

    rows = df.select(id_column, F.col(ids_column).alias("ids"))
    return map_rows(rows, run, f"`{id_column}` {kind}, text string")


def round_trip(df: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, n_tokens, ids, decoded``: both ways in one pass over the rows."""
    vocabulary = shared(df.sparkSession, bytelevel.Vocabulary(path))
    kind = df.schema[id_column].dataType.simpleString()

    def run(columns):
        encoder = _encoder(path, vocabulary)
        ids = encoder.encode(columns["text"])
        return {
            id_column: columns[id_column],
            "n_tokens": [len(i) // 4 for i in ids],
            "ids": ids,
            "decoded": [encoder.decode(i) for i in ids],
        }

    rows = df.select(id_column, text_of(text_column).alias("text"))
    return map_rows(rows, run, f"`{id_column}` {kind}, n_tokens bigint, ids binary, decoded string", after=_forget)


def op1_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the number of tokens and digests of its ids and of the decoded text."""
    coded = round_trip(table(spark, sf_dir, "documents"), bytelevel.vocabulary_path())
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
