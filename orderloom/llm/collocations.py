"""Collocations: phrases of two to five words that occur more often than their parts suggest.

Every word occurrence has one window, the word and its leads within the piece, five words at most,
padded at the piece's end. Only these longest windows are counted. ROLLUP over the window's columns
then sums the counts of ever shorter prefixes: a phrase occurs as often as windows begin with it,
so one pass of counting gives all phrases of one to five words, and its grand total all words.

A window is cut, that is padded further, where the phrase up to there surely occurs less than
``LEAST`` times: no phrase beyond that place can be a candidate or part of one, and the counts of
all others stay exact. What is surely rare, two filters say, one on words and neighbouring pairs,
the next on the phrases of three to five words that the first one leaves: each phrase of a language
falls into one of ``2 ** FILTER_BITS`` buckets, whose counts are summed over all documents and stop
at ``LEAST``. A filter is a bitmap of 32 MB at any input size, so sending it is bounded. On far more
text than buckets it rules out less and more of each window is shuffled; results do not depend on it.

Tasks read whole texts in parts of about ``PART`` bytes, carry the last four words over, and let
their window counts go once there are ``HELD`` of them, so neither a text nor a corpus is held. All
sums are taken partially before a shuffle; a word or language of a third of all rows is a row per
task. The first ``TOP`` phrases of a language are taken per task before they are merged.

Defined cases. Null text has no words; null lang is ``und``, together with a language of that name.
Every row counts, so repeated rows count again, and ids are not read. Words hold any characters but
blank, tab and the piece ends, whatever their length. Ties in rank end at the phrase, in UTF-8 byte
order. An empty table, or one without frequent phrases, gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.llm.common import Batches, shared, table, text_of
from orderloom.session import materialize

# Longest phrase, least occurrences of a candidate, ranks kept, name of no language.
LONGEST, LEAST, TOP, UNKNOWN = 5, 100, 2000, "und"
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"

#: Buckets of the filter, as a power of two; 2 ** 28 bits are 32 MB.
FILTER_BITS = 28
#: Buckets that travel together.
BLOCK_BITS = 16
#: Bytes of a text read at a time, window counts held by a task, words whose hash a task remembers.
PART, HELD, REMEMBERED = 1 << 20, 400_000, 300_000
#: Groups that windows are merged in, by their first word.
GROUPS = 1024
#: Bucket hits that are sorted and counted together.
HITS = 4_000_000

W = [f"w{k}" for k in range(1, LONGEST + 1)]

# Small letters for capitals, blank for tab, a line feed for every piece end.
_LETTERS = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + PIECE_ENDS, b"abcdefghijklmnopqrstuvwxyz " + b"\n" * len(PIECE_ENDS))
# Stands between pieces; UTF-8 has no such byte.
BREAK = b"\xff"
_ODD = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]


def _parts(text: str) -> Iterator[tuple[bytes, bool]]:
    """The text as plain bytes, cut between words, and whether it ends there."""
    whole = text.encode("utf-8", "surrogatepass").translate(_LETTERS)
    start, last = 0, False
    while not last:
        end = len(whole)
        if end - start > PART:
            stops = [k for k in (whole.find(b" ", start + PART), whole.find(b"\n", start + PART)) if k >= 0]
            end = min(stops, default=end)
        last = end == len(whole)
        yield whole[start:end].replace(b"\n", b" \xff "), last
        start = end


def token_runs(text: str) -> Iterator[tuple[list[bytes], int]]:
    """``tokens, fresh``: words and breaks in order; windows of the first ``fresh`` ones are complete in it.

    The tokens behind those come again at the front of the next run.
    """
    carried: list[bytes] = []
    for part, last in _parts(text):
        tokens = carried + part.split()
        fresh = len(tokens) if last else max(0, len(tokens) - (LONGEST - 1))
        if tokens:
            yield tokens, fresh
        carried = tokens[fresh:]


class _Hashes(dict):
    """Hashes of words, each taken once; 0 is the break's."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = 0 if word == BREAK else xxhash.xxh64_intdigest(word) | 1
        self[word] = value
        return value


def _levels(words: np.ndarray, language: int) -> list[np.ndarray]:
    """Buckets of the phrases of one to ``LONGEST`` words from every place on; meaningless across a break or the end."""
    shift = np.uint64(64 - FILTER_BITS)
    at = words * _ODD[0] ^ np.uint64(language)
    phrase, out = at, []
    for k in range(LONGEST):
        if k:
            following = np.zeros_like(at)
            following[: max(0, len(at) - k)] = at[k:]
            phrase = (phrase ^ phrase >> np.uint64(31)) * _ODD[2] + following
        out.append(((phrase ^ phrase >> np.uint64(31)) * _ODD[1] >> shift).astype("u4"))
    return out


def _language(name: str) -> int:
    return xxhash.xxh64_intdigest(name.encode("utf-8", "surrogatepass"))


def _rows(batches: Batches) -> Iterator[tuple[str, str]]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.column(0)[k].as_py(), batch.column(1)[k].as_py()


# --- the filters ----------------------------------------------------------------------------------


def _passes(bitmap: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    return (bitmap[bucket >> np.uint32(3)] >> (bucket & np.uint32(7)).astype("u1")) & 1 == 1


def _lengths(words: np.ndarray, levels: list[np.ndarray], short: np.ndarray, long: np.ndarray | None = None) -> np.ndarray:
    """Per word how many words its window keeps, 0 where the word itself is rare; -1 at breaks.

    The bitmap ``short`` judges words and pairs, ``long`` the phrases of three words and more.
    """
    is_word = words > 0
    alone = is_word.copy()
    alone[is_word] = _passes(short, levels[0][is_word])
    joined = np.zeros(len(words) + LONGEST, bool)
    joined[: len(words) - 1] = alone[:-1] & alone[1:]
    pairs = np.flatnonzero(joined)
    joined[pairs] = _passes(short, levels[1][pairs])
    lengths, going = alone.astype("i1"), alone
    for k in range(LONGEST - 1):
        going = going & joined[k : k + len(words)]
        lengths += going
    for k in range(3, LONGEST + 1) if long is not None else ():
        reach = np.flatnonzero(lengths >= k)
        lengths[reach[~_passes(long, levels[k - 1][reach])]] = k - 1
    lengths[~is_word] = -1
    return lengths


def _bucket_counts(short: Callable[[], bytes] | None = None) -> Callable[[Batches], Batches]:
    """``block, places, counts``: hit buckets and how often, up to LEAST, a block of buckets per row.

    Words and pairs are counted first; with their filter, the phrases of three words and more it leaves.
    """

    def counted(hits: list[np.ndarray]) -> pa.RecordBatch:
        buckets, counts = np.unique(np.concatenate(hits), return_counts=True)
        places = (buckets & np.uint32((1 << BLOCK_BITS) - 1)).astype("<u2")
        block = (buckets >> np.uint32(BLOCK_BITS)).astype("int32")
        counts = np.minimum(counts, LEAST).astype("u1")
        starts = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
        cut = lambda a: [x.tobytes() for x in np.split(a, starts[1:])]
        return pa.RecordBatch.from_pydict({"block": pa.array(block[starts]), "places": pa.array(cut(places)), "counts": pa.array(cut(counts))})

    def run(batches: Batches) -> Batches:
        bitmap = None if short is None else np.frombuffer(short(), "u1")
        hashes, hits, waiting = _Hashes(), [], 0
        for lang, text in _rows(batches):
            language = _language(lang)
            for tokens, fresh in token_runs(text):
                words = np.fromiter(map(hashes.__getitem__, tokens), "u8", len(tokens))
                levels = _levels(words, language)
                if bitmap is None:
                    is_word = words > 0
                    new = [levels[0][:fresh][is_word[:fresh]], levels[1][:-1][:fresh][(is_word[:-1] & is_word[1:])[:fresh]]]
                else:
                    lengths = _lengths(words, levels, bitmap)[:fresh]
                    new = [levels[k - 1][:fresh][lengths >= k] for k in range(3, LONGEST + 1)]
                hits += new
                waiting += sum(map(len, new))
                if waiting >= HITS:
                    yield counted(hits)
                    hits, waiting = [], 0
        if waiting:
            yield counted(hits)

    return run


def _block_bits(batches: Batches) -> Batches:
    """``block, bits`` of the blocks of a partition that is sorted by block; one block is held at a time."""
    block, total = None, np.zeros(1 << BLOCK_BITS, "u4")

    def done() -> pa.RecordBatch:
        bits = np.packbits(total >= LEAST, bitorder="little").tobytes()
        return pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "bits": pa.array([bits])})

    for batch in batches:
        for k in range(batch.num_rows):
            b = batch.column(0)[k].as_py()
            if b != block and block is not None:
                yield done()
                total[:] = 0
            block = b
            places = np.frombuffer(batch.column(1)[k].as_py(), "<u2")
            total[places] = np.minimum(total[places] + np.frombuffer(batch.column(2)[k].as_py(), "u1"), LEAST)
    if block is not None:
        yield done()


def frequent_filter(texts: DataFrame, short: Callable[[], bytes] | None = None) -> Callable[[], bytes]:
    """The bitmap of buckets that ``LEAST`` of the phrases in question fall into, for all executors."""
    counts = texts.mapInArrow(_bucket_counts(short), "block int, places binary, counts binary")
    merged = counts.repartition("block").sortWithinPartitions("block").mapInArrow(_block_bits, "block int, bits binary")
    size = 1 << BLOCK_BITS - 3
    bitmap = bytearray(1 << FILTER_BITS - 3)
    # At most 2 ** (FILTER_BITS - BLOCK_BITS) rows of one block each: the bitmap's own size.
    for row in merged.collect():
        bitmap[row.block * size : (row.block + 1) * size] = row.bits
    return shared(texts.sparkSession, bytes(bitmap))


# --- the windows ----------------------------------------------------------------------------------


def _windows(short: Callable[[], bytes], long: Callable[[], bytes]) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        bitmaps = [np.frombuffer(f(), "u1") for f in (short, long)]
        hashes, counts, held = _Hashes(), {}, 0

        def flushed() -> pa.RecordBatch:
            """A row per group of first words, its windows sorted: neighbours share their front and compress well."""
            groups: dict[int, list] = {}
            for lang, of in counts.items():
                for window, n in of.items():
                    first = window.partition(b" ")[0]
                    groups.setdefault(zlib.crc32(first) % GROUPS, []).append((lang, window.decode("utf-8", "surrogatepass"), n))
            counts.clear()
            for rows in groups.values():
                rows.sort()
            column = lambda k, kind: pa.array([[r[k] for r in rows] for rows in groups.values()], pa.list_(kind))
            return pa.RecordBatch.from_pydict({
                "part": pa.array(list(groups), pa.int32()), "langs": column(0, pa.string()),
                "windows": column(1, pa.string()), "counts": column(2, pa.int64()),
            })

        for lang, text in _rows(batches):
            language, of = _language(lang), counts.setdefault(lang, Counter())
            before = len(of)
            for tokens, fresh in token_runs(text):
                words = np.fromiter(map(hashes.__getitem__, tokens), "u8", len(tokens))
                lengths = _lengths(words, _levels(words, language), *bitmaps)[:fresh]
                of[b""] += int((lengths == 0).sum())
                of.update([tokens[k] for k in np.flatnonzero(lengths == 1).tolist()])
                several = np.flatnonzero(lengths > 1)
                of.update([b" ".join(tokens[a:b]) for a, b in zip(several.tolist(), (several + lengths[several]).tolist(), strict=True)])
            held += len(of) - before
            if held >= HELD:
                yield flushed()
                held = 0
        if counts:
            yield flushed()

    return run


def _merged(batches: Batches) -> Batches:
    """``lang, window, n`` of the groups of a partition that is sorted by group, a window once unless ``HELD`` are passed."""
    part, sums = None, Counter()

    def done() -> pa.RecordBatch:
        keys = list(sums)
        out = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array(list(sums.values()), pa.int64())]
        sums.clear()
        return pa.RecordBatch.from_arrays(out, names=["lang", "window", "n"])

    for batch in batches:
        for k in range(batch.num_rows):
            row = [column[k].as_py() for column in batch.columns]
            if sums and (row[0] != part or len(sums) >= HELD):
                yield done()
            part = row[0]
            for lang, window, n in zip(*row[1:], strict=True):
                sums[lang, window] += n
    if sums:
        yield done()


def phrase_counts(df: DataFrame, text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """``lang, words, phrase, f``: phrases of one to five words with at least ``LEAST`` occurrences.

    The row with 0 words has the number of all words of the language.
    """
    texts = df.select(F.coalesce(F.col(lang_column).cast("string"), F.lit(UNKNOWN)).alias("lang"), text_of(text_column).alias("text"))
    short = frequent_filter(texts)
    found = texts.mapInArrow(
        _windows(short, frequent_filter(texts, short)), "part int, langs array<string>, windows array<string>, counts array<bigint>"
    )
    windows = found.repartition("part").sortWithinPartitions("part").mapInArrow(_merged, "lang string, window string, n bigint")
    split = F.split("window", " ")
    padded = windows.select("lang", "n", *(F.coalesce(F.get(split, F.lit(k)), F.lit("")).alias(w) for k, w in enumerate(W)))
    rolled = padded.rollup("lang", *W).agg(F.sum("n").alias("f"), F.grouping_id().alias("gone"))
    # ROLLUP clears columns from the right and sets one bit of the grouping id for each; the whole total has no language.
    kept = rolled.withColumn("words", F.lit(LONGEST) - F.bit_count("gone")).where("words >= 0")
    last = F.element_at(F.array(*W), F.greatest("words", F.lit(1)))
    kept = kept.where((F.col("words") == 0) | ((last != "") & (F.col("f") >= LEAST)))
    phrase = F.array_join(F.slice(F.array(*W), F.lit(1), F.col("words")), " ")
    return kept.select("lang", "words", phrase.alias("phrase"), "f")


# --- scores ---------------------------------------------------------------------------------------


def scored(counts: DataFrame) -> DataFrame:
    """``lang, phrase, words, a, l, r, n, score`` of every candidate, by its lowest cut."""
    total = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    phrases = counts.where("words > 0")
    part = lambda name: phrases.select("lang", F.col("phrase").alias(f"{name}_phrase"), F.col("f").alias(name))
    split = F.split("phrase", " ")
    cut = lambda a, b: F.array_join(F.slice(split, a, b), " ")
    k = F.col("k")
    cuts = phrases.where("words > 1").withColumnRenamed("f", "a").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumns({"l_phrase": cut(F.lit(1), k), "r_phrase": cut(k + 1, F.col("words") - k)})
    both = cuts.join(part("l"), ["lang", "l_phrase"]).join(part("r"), ["lang", "r_phrase"]).join(total, "lang")
    # Exact: at most 37 digits above.
    score = F.expr("(cast(a as decimal(18,0)) * cast(n as decimal(16,0)) * 1000BD) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    lowest = F.min(F.struct(score.cast("bigint").alias("score"), "k", "l", "r")).alias("s")
    return both.groupBy("lang", "phrase", "words", "a", "n").agg(lowest).select("lang", "phrase", "words", "a", "s.l", "s.r", "n", "s.score")


def absorbed(counts: DataFrame) -> DataFrame:
    """``lang, phrase, longer``: phrases inside a candidate of one word more, with that one's most occurrences.

    A longer candidate that always holds a phrase has one of one word more between them, so these suffice.
    """
    split, n = F.split("phrase", " "), F.col("words")
    inner = lambda a: F.array_join(F.slice(split, a, n - 1), " ")
    inside = counts.where("words > 2").select("lang", "f", F.explode(F.array_distinct(F.array(inner(F.lit(1)), inner(F.lit(2))))).alias("phrase"))
    return inside.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))


def collocations(df: DataFrame, text_column: str = "text", lang_column: str = "lang", top: int = TOP) -> DataFrame:
    """The first ``top`` collocations of each language, ranked."""
    counts = materialize(phrase_counts(df, text_column, lang_column), "phrases")
    left = scored(counts).join(absorbed(counts), ["lang", "phrase"], "left").where("longer is null or longer < a")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    # Spark applies the limit per task before the shuffle, so a language's task gets ``top`` rows of each.
    ranked = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
with pieces as (
  select coalesce(lang, 'und') lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) piece
  from documents
), words as (
  select lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda w: w <> '') ws from pieces
), windows as (
  select lang, ws[i] w1, ws[i + 1] w2, ws[i + 2] w3, ws[i + 3] w4, ws[i + 4] w5
  from (select lang, ws, unnest(range(1, len(ws) + 1)) i from words)
), rolled as (
  select lang, w1, w2, w3, w4, w5, count(*) f, 6 - bit_count(grouping_id(lang, w1, w2, w3, w4, w5)) - 1 k
  from windows group by rollup (lang, w1, w2, w3, w4, w5)
), phrases as (
  select lang, k, concat_ws(' ', w1, w2, w3, w4, w5) phrase, f from rolled
  where k >= 1 and f >= 100 and [w1, w2, w3, w4, w5][k] is not null
), cuts as (
  select p.lang, p.phrase, p.k, p.f a, c, t.f n, string_split(p.phrase, ' ') ws
  from (select *, unnest(range(1, k)) c from phrases where k > 1) p join rolled t on t.k = 0 and t.lang = p.lang
), scored as (
  select x.*, l.f l, r.f r, (1000::hugeint * x.a * x.n) // (l.f::hugeint * r.f) score
  from cuts x join phrases l on l.lang = x.lang and l.phrase = array_to_string(x.ws[1:x.c], ' ')
    join phrases r on r.lang = x.lang and r.phrase = array_to_string(x.ws[x.c + 1:], ' ')
), lowest as (
  select * from scored qualify row_number() over (partition by lang, phrase order by score, c) = 1
), kept as (
  select * from lowest p where not exists (
    select 1 from phrases q where q.lang = p.lang and q.k > p.k and 100 * q.f >= 100 * p.a
      and contains(' ' || q.phrase || ' ', ' ' || p.phrase || ' '))
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score::bigint as score
from kept qualify rank <= 2000
"""
