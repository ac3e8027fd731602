"""Secrets in texts, told apart from widely copied examples by who else owns them.

Built-in functions only. Patterns find candidate spans; every candidate's hash is counted over
the corpus by distinct repositories and owners. A value of many owners is a copied example. A
value that few own, with the variety of a real key, looks live. Long mixed strings that no
pattern names are candidates too, and become spans when they look live.

An owner is a ``source``; a repository is one language of a source.

Texts are scanned once and spans kept with hashes in place of values. Counting goes over
(hash, owner, repository), then (hash, owner), then hash, so a value that a third of all rows
share is a row per task at each step; the join back to candidates can be split by Spark.

Work on a text grows with its length and its matches, not with pairs of matches.

Defined cases: null text is empty and has no spans; very long texts are scanned whole, in one task; repeated rows are reported each, and count
once as owners; a null source is an owner of its own; an empty table gives an empty result;
other columns are ignored. Positions are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.llm.common import table, text_of
from orderloom.session import materialize

# The base kinds in their order, their patterns, and the least length of a value.
KINDS = ("assign", "access", "hex", "mixed")
ASSIGN = (
    r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_LENGTH = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
BASE_KINDS = 3

# The method's own candidates: long strings with capitals, small letters and digits.
MIXED = r"[A-Za-z0-9+/_=-]{20,}"
#: From so many distinct owners on, a value is a copied example.
EXAMPLE_OWNERS = 3
#: Fewer different characters than this look like a placeholder.
LIVE_CHARACTERS = 6
#: Running sums over a text's matches are taken in pieces of so many.
PIECE = 256

_SPAN = "array<struct<start:int,kind:int,end:int,hash:binary,shaped:boolean>>"


def _shaped(value: Column) -> Column:
    """Whether a value has the variety of a real key."""
    return F.size(F.array_distinct(F.split(value, ""))) >= LIVE_CHARACTERS


def _bound(value: Column, body) -> Column:
    """``body`` of ``value``, worked out once; a plain lambda would work it out at every use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running_sums(lengths: Column) -> Column:
    """Sums up to each entry. Pieces are summed by themselves, so appending copies a piece at most."""

    def added(sums: Column, n: Column) -> Column:
        return F.concat(sums, F.array(n + F.coalesce(F.try_element_at(sums, F.lit(-1)), F.lit(0))))

    none = F.array().cast("array<int>")
    numbers = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / PIECE).cast("int"))
    pieces = F.transform(
        numbers, lambda k: F.aggregate(F.slice(lengths, k * PIECE + 1, F.lit(PIECE)), none, added)
    )
    before = lambda p: F.aggregate(p, F.array(F.lit(0)), lambda sums, one: added(sums, F.element_at(one, -1)))
    shifted = lambda p, b: F.transform(p, lambda one, k: F.transform(one, lambda n: n + F.get(b, k)))
    return _bound(pieces, lambda p: _bound(before(p), lambda b: F.flatten(shifted(p, b))))


def _spans(text: Column, pattern: str, kind: int, group: int = 0, keep=None) -> Column:
    """Every leftmost match as a struct; matches and the pieces between them give the positions."""
    found = F.struct(
        F.split(text, pattern, -1).alias("between"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("values"),
    )

    def placed(f: Column, ends: Column) -> Column:
        def span(match: Column, i: Column) -> Column:
            value, end = F.get(f["values"], i), F.get(ends, i)
            out = F.struct(
                (end - F.length(match)).alias("start"), F.lit(kind).alias("kind"), end.alias("end"),
                F.unhex(F.sha2(value, 256)).alias("hash"), _shaped(value).alias("shaped"),
            )
            return out if keep is None else F.when(keep(value), out)

        return F.filter(F.transform(f["matches"], span), lambda s: s.isNotNull())

    def walk(f: Column) -> Column:
        lengths = F.transform(f["matches"], lambda m, i: F.length(m) + F.length(F.get(f["between"], i)))
        ends = _bound(lengths, _running_sums)
        return _bound(ends, lambda e: placed(f, e)).cast(_SPAN)

    return F.when(text.rlike(pattern), _bound(found, walk)).otherwise(F.array().cast(_SPAN))


def candidates(df: DataFrame, text_column: str = "text") -> DataFrame:
    """``df`` with ``_base`` and ``_mixed``: candidate spans of the base kinds and of the method's own."""
    text = text_of(text_column)
    base = F.concat(
        _spans(text, ASSIGN, 0, 1, lambda v: F.length(v) >= ASSIGN_LENGTH),
        _spans(text, ACCESS, 1),
        _spans(text, HEX, 2),
    )
    varied = lambda v: v.rlike("[A-Z]") & v.rlike("[a-z]") & v.rlike("[0-9]")
    return df.withColumns({"_base": base, "_mixed": _spans(text, MIXED, 3, 0, varied)})


def ownership(found: DataFrame) -> DataFrame:
    """``hash, owners, repositories``: distinct ones per candidate hash of (hash, _owner, _repository) rows."""
    single = found.groupBy("hash", "_owner", "_repository").agg(F.lit(1).alias("n"))
    owned = single.groupBy("hash", "_owner").agg(F.count("*").alias("n"))
    return owned.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("n").alias("repositories"))


def judged(scanned: DataFrame, example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """``_row, spans``: each row's spans with ``live``; rows without candidates are left out.

    ``scanned`` has ``_row`` (unique), ``_owner``, ``_repository``, ``_base`` and ``_mixed``.
    The method's own candidates stay only where they look live and touch no base span.
    """
    found = scanned.select("_row", "_owner", "_repository", F.inline(F.concat("_base", "_mixed")))
    # Base spans sort before the method's own at one start, so two running values tell who is touched.
    base = F.col("kind") < BASE_KINDS
    earlier = Window.partitionBy("_row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    later = (
        Window.partitionBy("_row").orderBy(F.desc("start"), F.desc("kind"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    reached = F.max(F.when(base, F.col("end"))).over(earlier)
    coming = F.min(F.when(base, F.col("start"))).over(later)
    touched = F.coalesce(reached > F.col("start"), F.lit(False)) | F.coalesce(coming < F.col("end"), F.lit(False))
    spans = found.withColumn("_touched", touched).where(base | ~F.col("_touched")).drop("_touched")
    joined = spans.join(ownership(spans), "hash")
    live = F.col("shaped") & (F.col("owners") < example_owners)
    kept = joined.withColumn("live", live).where(F.col("live") | (F.col("kind") < BASE_KINDS))
    span = F.struct("start", "kind", "end", "live", "owners", "repositories")
    return kept.groupBy("_row").agg(F.array_sort(F.collect_list(span)).alias("spans"))


def _listed(spans: Column) -> Column:
    name = lambda k: F.element_at(F.array(*map(F.lit, KINDS)), k + 1)
    return F.array_join(
        F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", name(s["kind"]), s["start"], s["end"])), ","
    )


def _owned(df: DataFrame, source_column: str, language_column: str) -> dict[str, Column]:
    return {
        "_row": F.monotonically_increasing_id(),
        "_owner": F.coalesce(F.col(source_column), F.lit("")),
        "_repository": F.coalesce(F.col(language_column), F.lit("")),
    }


def find_secrets(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
    language_column: str = "lang",
) -> DataFrame:
    """One row per row of ``df``: counts per base kind, all spans as text, and what looks live."""
    owned = df.select(id_column, text_column, source_column, language_column).withColumns(
        _owned(df, source_column, language_column)
    )
    scanned = materialize(candidates(owned, text_column).drop(text_column, source_column, language_column), "candidates")
    of_kind = lambda k: F.size(F.filter("_base", lambda s: s["kind"] == k)).cast("bigint")
    rows = scanned.join(judged(scanned), "_row", "left")
    spans = F.coalesce("spans", F.array().cast("array<struct<start:int,kind:int,end:int,live:boolean,owners:bigint,repositories:bigint>>"))
    return rows.select(
        id_column,
        *(of_kind(k).alias(f"n_{KINDS[k]}") for k in range(BASE_KINDS)),
        F.sha2(_listed(F.transform("_base", lambda s: F.struct(s["start"], s["kind"], s["end"]))), 256).alias("base_sha256"),
        _listed(spans).alias("spans"),
        _listed(F.filter(spans, lambda s: s["live"])).alias("live_spans"),
        F.size(F.filter(spans, lambda s: s["live"])).cast("bigint").alias("n_live"),
        F.size(F.filter(spans, lambda s: ~s["live"])).cast("bigint").alias("n_copied"),
    )


def redact(
    df: DataFrame, text_column: str = "text", source_column: str = "source", language_column: str = "lang",
    mark: str = "[REDACTED]",
) -> DataFrame:
    """``df`` with every span that is no widely copied example replaced in its text.

    Rows without candidates pass without a join, so only the few others are shuffled.
    """
    # By position, so that no column of ``df`` meets a working column's name.
    names = df.columns
    placed = [f"c{k}" for k in range(len(names))]
    at = lambda name: placed[names.index(name)]
    text_column, source_column, language_column = at(text_column), at(source_column), at(language_column)
    df = df.toDF(*placed)
    whole = df.withColumns(_owned(df, source_column, language_column))
    scanned = materialize(candidates(whole, text_column), "scanned")
    some = F.size(F.concat("_base", "_mixed")) > 0
    found = scanned.where(some)
    hidden = F.filter("spans", lambda s: s["owners"] < EXAMPLE_OWNERS)
    text = F.col(text_column)

    def step(state: Column, s: Column) -> Column:
        between = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(s["start"] >= state["at"], F.concat(state["out"], between, F.lit(mark)))
            .otherwise(state["out"]).alias("out"),
        )

    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text)))
    cleaned = F.when(F.size(hidden) > 0, F.aggregate(hidden, first, step, rest)).otherwise(text)
    mended = found.join(judged(found), "_row", "left").withColumn(text_column, cleaned)
    return scanned.where(~some).select(*placed).unionByName(mended.select(*placed)).toDF(*names)


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))
