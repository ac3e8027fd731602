"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or abstain on every document. Expectation
maximisation estimates how often each labeller is right when it votes, from the counts of vote
patterns over the whole corpus; there are at most 3^labellers of them, whatever the corpus
size. To abstain says nothing, and a detector of one kind of junk abstains on all else. The posterior labels train a linear scorer over hashed word and word-shape features plus
the votes, and the scorer decides. Two tasks are learned side by side by the same code: junk
text, and insulting text.

The scorer is fitted on about ``TRAIN_ROWS`` documents, and never more than twice as many, that a
hash of id, votes and features picks; documents alike in all of these teach once. The word list of
the insult labellers is learned from at most ``LABEL_ROWS`` labelled rows, picked by a hash of the
id, and has at most ``LEXICON_WORDS`` words; without labels those labellers only know the fixed
list. The shape feature of a word reads its first 40 characters. Votes, pattern counts and
decisions cover every row and whole texts.

Defined cases: null and empty texts have no words, so every labeller abstains and they are
kept; repeated rows are scored alike and each counts; rows without id are rows like all others,
however many; an empty table teaches nothing and leaves the prior; a corpus
of one label gives a scorer that keeps everything the labellers do not reject; other columns are
ignored.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.common import map_rows, table, text_of
from orderloom.session import materialize

DIMENSIONS = 256
TRAIN_ROWS = 8_000
LABEL_ROWS = 20_000
#: A learned insult is in so many labelled insulting texts at least, and hardly in others.
LEXICON_TEXTS = 6
LEXICON_OTHERS = 0.03
LEXICON_WORDS = 5_000
KEEP_BELOW = 0.5
#: A labeller's votes are right more often than not, and never always; few texts are bad.
RIGHT_RANGE = (0.55, 0.995)
PRIOR_RANGE = (0.005, 0.5)
# Plain English insults, for corpora without labels.
INSULTS = ("stupid", "disgusting", "clown", "trash", "moron", "worthless", "scum", "pathetic", "idiot", "loser")

GOOD, ABSTAIN, BAD = 0, 1, 2
JUNK = ("capitals", "decorated", "table", "stutter", "variety", "symbols", "upper", "dominant", "prose")
TOXIC = ("insults", "several_insults", "listed_insults", "insult_share")
LABELLERS = JUNK + TOXIC
TASKS = {"junk": range(len(JUNK)), "toxic": range(len(JUNK), len(LABELLERS))}

_DECORATED = re.compile(r"[!$*&#%@~^=]{2,}$").search
_WORD = re.compile(r"\w+")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_SYMBOL = re.compile(r"[^\w\s.,;:'\"()-]")
MEMORY_WORDS = 150_000


def vote(value: float, good_below: float, bad_above: float) -> int:
    return BAD if value > bad_above else GOOD if value < good_below else ABSTAIN


def against(value: float, bad_above: float) -> int:
    return BAD if value > bad_above else ABSTAIN


class Labellers:
    """Votes and hashed features of texts; facts about words are remembered per process."""

    def __init__(self, lexicon: frozenset[str]):
        self.lexicon = lexicon
        self.words: dict[str, tuple[int, int, bool, bool, int]] = {}

    def word(self, word: str) -> tuple[int, int, bool, bool, int]:
        """(feature of the word, feature of its shape, all capitals, decorated, insult number)."""
        known = self.words.get(word)
        if known is None:
            shape = re.sub(r"(.)\1+", r"\1", "".join(_class(c) for c in word[:40]))
            bare = word.lower().strip(".,;:!?\"'()$*&#%|")
            insult = 2 if bare in INSULTS else 1 if bare in self.lexicon else 0
            known = (
                zlib.crc32(bare.encode()) % (DIMENSIONS // 2),
                DIMENSIONS // 2 + zlib.crc32(shape.encode()) % (DIMENSIONS // 2),
                len(bare) > 1 and word.isupper(),
                _DECORATED(word) is not None,
                insult,
            )
            if len(self.words) >= MEMORY_WORDS:
                self.words.clear()
            self.words[word] = known
        return known

    def text(self, text: str) -> tuple[bytes, bytes]:
        words = text.split()
        n = len(words)
        if not n:
            return bytes([ABSTAIN] * len(LABELLERS)), np.zeros(DIMENSIONS, "f2").tobytes()
        counts: dict[str, int] = {}
        for w in words:
            counts[w] = counts.get(w, 0) + 1
        features = np.zeros(DIMENSIONS)
        capitals = decorated = 0
        insults: set[str] = set()
        listed = hits = 0
        word = self.word
        for w, c in counts.items():
            a, b, upper, marked, insult = word(w)
            features[a] += c
            features[b] += c
            capitals += c * upper
            decorated += c * marked
            if insult:
                insults.add(w.lower().strip(".,;:!?"))
                hits += c
                listed += insult == 2
        stutter = sum(map(str.__eq__, words, words[1:])) / n
        letters = max(1, len(text))
        plain = sum(c for w, c in counts.items() if w.rstrip(".,").isalpha() and not w.isupper()) / n
        seen = [
            against(capitals / n, 0.2),
            against(decorated / n, 0.15),
            against(counts.get("|", 0) / n, 0.1),
            against(stutter, 0.12),
            vote(-len(counts) / n, -0.4, -0.15) if n >= 30 else ABSTAIN,
            against(len(_SYMBOL.findall(text)) / letters, 0.06),
            against(len(_UPPER.findall(text)) / letters, 0.25),
            against(max(counts.values()) / n, 0.3) if n >= 30 else ABSTAIN,
            vote(stutter - plain, -0.85, -0.6),
            BAD if hits > 1 else ABSTAIN if hits else GOOD,
            BAD if len(insults) > 1 else ABSTAIN if insults else GOOD,
            BAD if listed else ABSTAIN,
            against(hits / n, 0.003),
        ]
        return bytes(seen), (features / n).astype("f2").tobytes()


def _class(c: str) -> str:
    return "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c


@dataclass
class Task:
    """One hidden label: how often each labeller's votes are right, and the scorer trained on that."""

    members: list[int]
    prior: float = 0.1
    right: np.ndarray = field(default_factory=lambda: np.zeros(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def sides(self, votes: np.ndarray) -> np.ndarray:
        """1 for bad, -1 for good, 0 for no vote."""
        return votes[:, self.members].astype("i8") - 1

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(bad | votes) for rows of votes."""
        odds = np.log(self.prior / (1 - self.prior)) + self.sides(votes) @ np.log(self.right / (1 - self.right))
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))

    def estimate(self, patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> None:
        """Expectation maximisation over vote patterns, from labellers that are all right nine times in ten."""
        sides = self.sides(patterns)
        self.right = np.full(len(self.members), 0.9)
        for _ in range(rounds):
            bad = self.posterior(patterns)
            self.prior = float(np.clip((counts @ bad + 1) / (counts.sum() + 10), *PRIOR_RANGE))
            agree = counts @ np.where(sides > 0, bad[:, None], np.where(sides < 0, 1 - bad[:, None], 0))
            new = np.clip((agree + 9) / (counts @ (sides != 0) + 10), *RIGHT_RANGE)
            done = np.abs(new - self.right).max() < 1e-7
            self.right = new
            if done:
                break

    def inputs(self, votes: np.ndarray, features: np.ndarray) -> np.ndarray:
        shown = np.eye(3)[votes[:, self.members]].reshape(len(votes), 3 * len(self.members))
        return np.hstack([np.ones((len(votes), 1)), 4 * shown, 4 * features])

    def fit(self, votes: np.ndarray, features: np.ndarray, steps: int = 300, penalty: float = 1e-4) -> None:
        """Logistic regression on the posteriors, by gradient steps with momentum."""
        x, y = self.inputs(votes, features), self.posterior(votes)
        w = np.zeros(x.shape[1])
        w[0] = np.log(self.prior / (1 - self.prior))
        if not len(x):  # nothing to learn from: the prior alone
            self.weights = w
            return
        speed, rate = np.zeros_like(w), 4.0 * max(len(x), 1) / max((x**2).sum(), 1e-9)
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            speed = 0.9 * speed - rate * (x.T @ (p - y) / max(len(y), 1) + penalty * w)
            w = w + speed
        self.weights = w

    def score(self, votes: np.ndarray, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.inputs(votes, features) @ self.weights, -30, 30)))


@dataclass
class Model:
    lexicon: frozenset[str]
    tasks: dict[str, Task]

    def accuracies(self) -> dict[str, float]:
        """How often each labeller is right when it votes, as estimated."""
        return {LABELLERS[c]: float(r) for t in self.tasks.values() for c, r in zip(t.members, t.right)}


def _pick(rate: float, *names: str):
    """A hashed share of the rows, by what they hold, so that rows without id are not taken as one."""
    return F.pmod(F.xxhash64(F.lit(31), *names), F.lit(1 << 30)) < int(rate * (1 << 30))


def learn_lexicon(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", rows: int = LABEL_ROWS
) -> frozenset[str]:
    """Words of labelled insulting texts that other labelled texts hardly have."""
    found = labels.where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = found.orderBy(F.xxhash64(F.lit(31), "doc_id"), "doc_id").limit(rows)
    picked = materialize(picked.withColumnRenamed("doc_id", "_id"), "labelled")
    total = {r.toxic: r.n for r in picked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not total.get(1) or not total.get(0):
        return frozenset()
    # At most ``rows`` rows of two numbers.
    joined = docs.select(F.col(id_column).alias("_id"), text_of(text_column).alias("text")).join(F.broadcast(picked), "_id")
    # Copies of one text count once, else all its words would look telling.
    single = joined.groupBy(F.xxhash64(F.substring("text", 1, 1 << 30)).alias("key"), "toxic").agg(F.min_by("text", "_id").alias("text"))
    words = single.select("key", "toxic", F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"))).alias("word"))
    counted = words.groupBy("word").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("other"))
    share = total[1] / total[0]
    telling = counted.where(
        (F.length("word") > 2) & (F.col("bad") >= LEXICON_TEXTS) & (F.col("other") * share <= LEXICON_OTHERS * F.col("bad"))
    )
    top = telling.orderBy(F.desc("bad"), "word").limit(LEXICON_WORDS).collect()
    return frozenset(r.word for r in top)


_LABELLERS: dict[int, Labellers] = {}


def _labellers(lexicon: frozenset[str]) -> Labellers:
    key = hash(lexicon)
    if key not in _LABELLERS:
        _LABELLERS.clear()
        _LABELLERS[key] = Labellers(lexicon)
    return _LABELLERS[key]


def _forget() -> None:
    """The worker process goes on to other tasks, which need the memory."""
    _LABELLERS.clear()


def votes(df: DataFrame, lexicon: frozenset[str], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, votes, features`` per row: a byte per labeller, and hashed features as 16-bit floats."""
    kind = df.schema[id_column].dataType.simpleString()

    def run(columns):
        labellers = _labellers(lexicon)
        found = [labellers.text(t) for t in columns["text"]]
        return {id_column: columns[id_column], "votes": [v for v, _ in found], "features": [f for _, f in found]}

    rows = df.select(id_column, text_of(text_column).alias("text"))
    return map_rows(rows, run, f"`{id_column}` {kind}, votes binary, features binary", after=_forget)


def _matrices(rows_votes: list[bytes], rows_features: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    v = np.frombuffer(b"".join(rows_votes), "u1").reshape(-1, len(LABELLERS))
    f = np.frombuffer(b"".join(rows_features), "f2").reshape(-1, DIMENSIONS).astype("f8")
    return v, f


def fit(voted: DataFrame, lexicon: frozenset[str], id_column: str = "doc_id", train_rows: int = TRAIN_ROWS) -> Model:
    """Learn from written votes: pattern counts over all rows, the scorer on about ``train_rows``."""
    counted = voted.groupBy("votes").count().collect()  # at most 3^labellers rows
    patterns = np.frombuffer(b"".join(bytes(r.votes) for r in counted), "u1").reshape(-1, len(LABELLERS))
    counts = np.array([r["count"] for r in counted], "f8")
    model = Model(lexicon, {name: Task(list(members)) for name, members in TASKS.items()})
    rate = min(1.0, train_rows / max(counts.sum(), 1))
    # Rows that are alike in all teach once, so copies of one row cannot fill the sample; twice the wanted rows at most.
    picked = voted.where(_pick(rate, id_column, "votes", "features")).select("votes", "features").distinct()
    sample = picked.limit(2 * train_rows).collect()
    v, f = _matrices([bytes(r.votes) for r in sample], [bytes(r.features) for r in sample])
    for task in model.tasks.values():
        task.estimate(patterns, counts)
        task.fit(v, f)
    return model


def score(voted: DataFrame, model: Model, id_column: str = "doc_id") -> DataFrame:
    """``id, votes, junk, toxic``: the scorer's probabilities of either fault."""
    kind = voted.schema[id_column].dataType.simpleString()

    def run(columns):
        v, f = _matrices(columns["votes"], columns["features"])
        return {id_column: columns[id_column], "votes": columns["votes"]} | {
            name: task.score(v, f).tolist() for name, task in model.tasks.items()
        }

    schema = f"`{id_column}` {kind}, votes binary, junk double, toxic double"
    return map_rows(voted.select(id_column, "votes", "features"), run, schema)


def kept(scored: DataFrame) -> DataFrame:
    return scored.where((F.col("junk") < KEEP_BELOW) & (F.col("toxic") < KEEP_BELOW))


def train(docs: DataFrame, labels: DataFrame | None, id_column: str = "doc_id", text_column: str = "text"):
    """The model, and the written votes it was learned from."""
    lexicon = learn_lexicon(docs, labels, id_column, text_column) if labels is not None else frozenset()
    voted = materialize(votes(docs, lexicon, id_column, text_column), "votes")
    return fit(voted, lexicon, id_column), voted


def filter_rows(df: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """The rows of ``df`` that the scorer keeps, with all their columns, without a shuffle."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)

    def run(columns):
        labellers = _labellers(model.lexicon)
        found = [labellers.text(t or "") for t in columns[text_column]]
        v, f = _matrices([a for a, _ in found], [b for _, b in found])
        bad = np.zeros(len(v), bool)
        for task in model.tasks.values():
            bad |= task.score(v, f) >= KEEP_BELOW
        keep = np.flatnonzero(~bad)
        return {n: [c[k] for k in keep] for n, c in columns.items()}

    return map_rows(df, run, schema, after=_forget)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents the classifier keeps, with the probabilities of junk and of insulting text."""
    model, voted = train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    name = F.array(*map(F.lit, LABELLERS))
    against = F.filter(
        name, lambda n, i: F.substring(F.hex("votes"), (2 * i + 1).cast("int"), F.lit(2)) == F.lit(f"{BAD:02d}")
    )
    return kept(score(voted, model)).select("doc_id", "junk", "toxic", F.array_join(against, ",").alias("votes_against"))
