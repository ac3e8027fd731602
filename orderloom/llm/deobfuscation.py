"""Personal data in texts, plain or disguised, with spans that point into the source.

Three transducers rewrite a text one after another and keep for every rewritten stretch the
stretch it came from: look-alike, wide and invisible characters become plain ones; digits that are
spelled out become digits; "at" and "dot" disguises become signs. The four detectors run over the
source, which gives the base spans, and over the rewritten text; what they find there goes back
through the three mappings to source characters.

A span of the rewritten text is added when a rewritten stretch has part in it and no base span of
its kind covers it. "at" between blanks only counts before a name with a disguised dot.

The detectors are linear in the text: an email starts from its sign and looks back no further than
the sign before, a run of digits is read once. A task holds a few texts at a time and nothing is
shuffled, so a hot source or a frequent value changes nothing.

Defined cases. Null text is empty and has no spans; null ids stay null. Every row gives a row, so
repeated rows are reported each. Texts of any length are read whole. Of two base spans of one kind
the one further left wins; spans of different kinds may overlap, and are listed by start, kind and
end. An empty table gives an empty result. Other columns, whatever their names, are ignored by
``find_personal_data`` and kept by ``masked``. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.common import map_rows, table, text_of

Span = tuple[int, int]

# --- detectors: fixed values are the patterns and bounds of the four kinds ------------------------

KINDS = ("email", "ip", "card", "phone")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# Every run of digits is taken once; only those with three more parts count.
IP = re.compile(r"[0-9]++((?:\.[0-9]++){3})?")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS = (14, 19), (10, 15)

NOT_DIGITS = re.compile("[^0-9]+")


def emails(text: str) -> list[Span]:
    found, left, at = [], 0, text.find("@")
    while at >= 0:
        start = left + len(text[left:at].rstrip(LOCAL))
        match = DOMAIN.match(text, at) if start < at else None
        if match:
            found.append((start, match.end()))
        left = match.end() if match else at + 1
        at = text.find("@", left)
    return found


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def addresses(text: str) -> list[Span]:
    return [m.span() for m in IP.finditer(text) if m[1] and all(map(_small, m[0].split(".")))]


def luhn(digits: str) -> bool:
    double = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + double) % 10 == 0


def cards(text: str) -> list[Span]:
    found = []
    for m in CARD.finditer(text):
        if m.end() - m.start() >= CARD_DIGITS[0]:
            digits = m[0].replace(" ", "").replace("-", "")
            if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
                found.append(m.span())
    return found


def phones(text: str) -> list[Span]:
    least, most = PHONE_DIGITS
    return [m.span() for m in PHONE.finditer(text) if least <= len(NOT_DIGITS.sub("", m[0])) <= most]


DETECTORS: tuple[Callable[[str], list[Span]], ...] = (emails, addresses, cards, phones)

# --- transducers ----------------------------------------------------------------------------------

# Letters of other scripts that look like a plain letter, in pairs.
LOOK_ALIKE = dict(
    pair.split("=") for pair in (
        "а=a в=B е=e к=k м=M н=H о=o р=p с=c т=T у=y х=x ѕ=s і=i ј=j ԁ=d ԛ=q ԝ=w һ=h ӏ=l ɡ=g "
        "А=A В=B Е=E К=K М=M Н=H О=O Р=P С=C Т=T У=Y Х=X Ѕ=S І=I Ј=J Ԛ=Q Ԝ=W "
        "α=a ε=e ι=i κ=k ν=v ο=o ρ=p τ=t υ=u χ=x "
        "Α=A Β=B Ε=E Ζ=Z Η=H Ι=I Κ=K Μ=M Ν=N Ο=O Ρ=P Τ=T Υ=Y Χ=X "
        "ı=i ℓ=l ∙=. 。=."
    ).split()
)
DASHES = "\u2010\u2011\u2012\u2013\u2014\u2015\u2212\ufe63"
BLANKS = "\u00a0\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"


def _plain(character: str) -> str | None:
    """The plain form of a character that has one, by its Unicode properties."""
    digit = unicodedata.decimal(character, None)
    if digit is not None:
        return str(digit)
    form = unicodedata.normalize("NFKC", character)
    return form if len(form) == 1 and "!" <= form <= "~" else None


def _glyphs() -> dict[str, str]:
    table_ = {c: p for k in (*range(0x80, 0x3000), *range(0xFE50, 0x10000), *range(0x10400, 0x1FC00)) if (p := _plain(c := chr(k)))}
    table_ |= LOOK_ALIKE
    table_ |= dict.fromkeys(DASHES, "-") | dict.fromkeys(BLANKS, " ") | dict.fromkeys(INVISIBLE, "")
    return table_


GLYPHS = _glyphs()

# The digits in four languages, nought first, and the words for the two signs.
SPELLED = (
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
)
DIGIT_OF = {word: str(k) for line in SPELLED for k, word in enumerate(line.split())}
AT_WORDS, DOT_WORDS, PLUS_WORDS = "at|arroba|ät", "dot|punto|punkt|point", ("plus", "más")
JOINS = " -"

_open, _close = r"\x20{0,2}[\[({<]\x20?", r"\x20?[\])}>]\x20{0,2}"
DOT = rf"(?:{_open}(?:{DOT_WORDS}|\.){_close}|\x20?[\x20_-](?:{DOT_WORDS})[\x20_-]\x20?)"
AT = rf"(?:{_open}(?:{AT_WORDS}|@){_close})"
BARE_AT = rf"(?:\x20?[\x20_-](?:{AT_WORDS})[\x20_-]\x20?)(?=[a-z0-9-]{{1,63}}{DOT}[a-z0-9])"
SIGNS = re.compile(rf"(?:({AT}|{BARE_AT})|{DOT})(?=[a-z0-9])")
# No sign can be there without one of these.
SIGN_MARKS = (*"[({<", *DOT_WORDS.split("|"))


class Rewritten:
    """A text after some stretches were replaced, with the way back to the text before."""

    def __init__(self, text: str, edits: Iterable[tuple[int, int, str]]):
        parts, at, length = [], 0, 0
        self.new: list[int] = []  # where each replacement starts and ends, here and in the text before
        self.new_end: list[int] = []
        self.old: list[int] = []
        self.old_end: list[int] = []
        for start, end, by in edits:
            parts += (text[at:start], by)
            length += start - at
            self.new.append(length)
            length += len(by)
            self.new_end.append(length)
            self.old.append(start)
            self.old_end.append(end)
            at = end
        self.text = "".join((*parts, text[at:]))

    def _back(self, position: int, ends: bool) -> int:
        """Where the character at ``position`` started or ended before."""
        k = bisect_right(self.new, position) - 1
        # Of a removal and a replacement at one place the later one holds the character.
        if k < 0:
            return position + ends
        if position < self.new_end[k]:
            return self.old_end[k] if ends else self.old[k]
        return position - self.new_end[k] + self.old_end[k] + ends

    def back(self, start: int, end: int) -> Span:
        return self._back(start, False), self._back(end - 1, True)

    def touched(self, start: int, end: int) -> bool:
        """Whether a replacement, or a removal inside, has part in the stretch."""
        k = bisect_left(self.new, start)
        if k and self.new_end[k - 1] > start:
            return True
        while k < len(self.new) and self.new[k] < end:
            if self.new_end[k] > self.new[k] or self.new[k] > start:
                return True
            k += 1
        return False


def _small_letters(text: str) -> str:
    """Lower case of the same length; the one letter that would become two is replaced first."""
    return text.replace("\u0130", "i").lower()


def _plain_glyphs(text: str) -> list[tuple[int, int, str]]:
    odd = "" if text.isascii() else "".join(sorted(GLYPHS.keys() & set(text)))
    if not odd:
        return []
    return [(*m.span(), GLYPHS[m[0]]) for m in re.finditer(f"[{re.escape(odd)}]", text)]


def _digits(text: str) -> list[tuple[int, int, str]]:
    """Runs of digit words that one blank or hyphen joins, with a plus word before them."""
    small = _small_letters(text)
    hits = []
    for word, digit in DIGIT_OF.items():
        at = small.find(word)
        while at >= 0:
            end = at + len(word)
            if not (small[at - 1 : at].isalnum() or small[end : end + 1].isalnum()):
                hits.append((at, end, digit))
            at = small.find(word, end)
    out: list[tuple[int, int, str]] = []
    run: list[str] = []
    start = last = -1
    for at, end, digit in [*sorted(hits), (len(text) + 2, -1, "")]:
        if run and at == last + 1 and small[last] in JOINS:
            run.append(digit)
        else:
            if run:
                plus = next((w for w in PLUS_WORDS if small.endswith((f"{w} ", f"{w}-"), max(0, start - len(w) - 1), start)), None)
                plus = None if plus is None or small[max(0, start - len(plus) - 2) : start - len(plus) - 1].isalnum() else plus
                out.append((start - (len(plus) + 1 if plus else 0), last, ("+" if plus else "") + "".join(run)))
            run, start = [digit], at
        last = end
    return out


def _signs(text: str) -> list[tuple[int, int, str]]:
    small = _small_letters(text)
    if not any(mark in small for mark in SIGN_MARKS):
        return []
    out, match = [], SIGNS.search(small)
    while match:
        at = match.start()
        stands = small[at - 1 : at].isascii() and small[at - 1 : at].isalnum()
        if stands:
            out.append((*match.span(), "@" if match[1] else "."))
        match = SIGNS.search(small, match.end() if stands else at + 1)
    return out


TRANSDUCERS = (_plain_glyphs, _digits, _signs)


def spans_of(text: str) -> list[tuple[int, int, int, bool, str]]:
    """``start, kind, end, base, value`` of every span, in that order; ``value`` is the plain form."""
    base = [detect(text) for detect in DETECTORS]
    found = [(a, kind, b, True, text[a:b]) for kind, spans in enumerate(base) for a, b in spans]
    layers, now = [], text
    for transducer in TRANSDUCERS:
        edits = transducer(now)
        if edits:
            layers.append(Rewritten(now, edits))
            now = layers[-1].text
    if layers:
        for kind, detect in enumerate(DETECTORS):
            # Base spans of a kind do not overlap, so the last one that starts no later could cover.
            starts = [a for a, _ in base[kind]]
            for start, end in detect(now):
                a, b, new = start, end, False
                for layer in reversed(layers):
                    new = new or layer.touched(a, b)
                    a, b = layer.back(a, b)
                k = bisect_right(starts, a) - 1
                if new and not (k >= 0 and base[kind][k][1] >= b):
                    found.append((a, kind, b, False, now[start:end]))
    return sorted(found)


def _listed(spans: Iterable[tuple]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end, *_ in spans)


SPANS = "array<struct<kind:string,start:int,end:int,base:boolean,value:string>>"


def find_personal_data(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row: counts of the base kinds, digests of the spans, and the spans themselves (``found``)."""
    kind = df.schema[id_column].dataType.simpleString()

    def scan(columns: dict[str, list]) -> dict[str, list]:
        every = [spans_of(text) for text in columns["text"]]
        base = [[s for s in spans if s[3]] for spans in every]
        out = {"id": columns["id"], "base_sha256": [hashlib.sha256(_listed(b).encode()).hexdigest() for b in base]}
        for k, name in enumerate(KINDS):
            out[f"n_{name}"] = [sum(s[1] == k for s in b) for b in base]
        out["spans"] = [_listed(spans) for spans in every]
        out["found"] = [
            [{"kind": KINDS[k], "start": a, "end": b, "base": plain, "value": value} for a, k, b, plain, value in spans] for spans in every
        ]
        return out

    counts = ", ".join(f"n_{name} bigint" for name in KINDS)
    rows = df.select(F.col(id_column).alias("id"), text_of(text_column).alias("text"))
    scanned = map_rows(rows, scan, f"id {kind}, {counts}, base_sha256 string, spans string, found {SPANS}", rows=500)
    return scanned.withColumnRenamed("id", id_column)


def masked(df: DataFrame, text_column: str = "text") -> DataFrame:
    """``df`` with every span, plain or disguised, replaced by its kind in brackets; null text stays null."""
    names = df.columns

    def hide(text: str | None) -> str | None:
        if text is None:
            return None
        parts, at = [], 0
        for start, kind, end, *_ in spans_of(text):
            if start >= at:
                parts += (text[at:start], f"[{KINDS[kind].upper()}]")
            at = max(at, end)
        return "".join((*parts, text[at:]))

    def rewrite(columns: dict[str, list]) -> dict[str, list]:
        return columns | {text_column: [hide(text) for text in columns[text_column]]}

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return map_rows(df.select(*(f"`{n}`" for n in names)), rewrite, schema, rows=500)


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts of ``documents``; not as SQL, since SQL has no match positions."""
    found = find_personal_data(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *(f"n_{name}" for name in KINDS), "base_sha256", "spans", F.size("found").cast("bigint").alias("n_spans"))
