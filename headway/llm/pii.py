"""Personal data in texts: plain identifiers, and disguised ones found after reversible normalisation.

Three transducers rewrite a text: look-alike characters to ASCII, spelled digits to digits, written-out "at" and "dot"
to ``@`` and ``.``. Each carries, for every character it emits, the half-open range of source characters the character
stands for, so a span found in the normalised text maps back to the exact source characters. Work is linear in the text.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructType

from headway.llm.common import Batches, texts_of, with_columns

KINDS = ("email", "ip", "card", "phone")


class Span(NamedTuple):
    kind: str
    start: int
    end: int


# --- Plain identifiers

_LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBER_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NUMBER = re.compile(r"[0-9]+")
_NO_DIGIT = re.compile(r"[^0-9]+")


def _emails(text: str) -> Iterator[Span]:
    """Look for each @ and extend to both sides; no character is looked at twice from the left."""
    floor, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > floor and text[start - 1] in _LOCAL_PART:
                start -= 1
            if start < at:
                yield Span("email", start, domain.end())
                floor = domain.end()
        at = text.find("@", max(at + 1, floor))


def _ips(text: str) -> Iterator[Span]:
    """Each maximal chain of dotted numbers gives its consecutive quadruples."""
    for chain in _NUMBER_CHAIN.finditer(text):
        if chain.group().count(".") < 3:
            continue
        parts = list(_NUMBER.finditer(text, chain.start(), chain.end()))
        for first in range(0, len(parts) - 3, 4):
            four = parts[first : first + 4]
            if all(len(x := part.group().lstrip("0")) <= 3 and int(x or 0) <= 255 for part in four):
                yield Span("ip", four[0].start(), four[3].end())


def luhn(digits: str) -> bool:
    """Whether the check digit holds."""
    doubled = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)
    total = sum(int(c) for c in digits[-1::-2]) + sum(doubled[int(c)] for c in digits[-2::-2])
    return total % 10 == 0


def _cards(text: str) -> Iterator[Span]:
    for found in _CARD.finditer(text):
        if found.end() - found.start() >= 12:
            digits = _NO_DIGIT.sub("", found.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield Span("card", found.start(), found.end())


def _phones(text: str) -> Iterator[Span]:
    for found in _PHONE.finditer(text):
        if 9 <= len(_NO_DIGIT.sub("", found.group())) <= 15:
            yield Span("phone", found.start(), found.end())


_FINDERS = (_emails, _ips, _cards, _phones)


def plain_spans(text: str) -> list[Span]:
    """Undisguised identifiers, leftmost and non-overlapping per kind, by start and then kind."""
    return ordered(span for find in _FINDERS for span in find(text))


def ordered(spans) -> list[Span]:
    return sorted(spans, key=lambda span: (span.start, KINDS.index(span.kind), span.end))


# --- Transducers: (start, end, replacement) edits of a text, by start, not overlapping

# Letters that look like an ASCII letter, each with the one it looks like.
LOOKALIKES = dict(
    zip(
        "АВЕЅІЈКМНОРСТУХаеѕіјорсухԁԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧαικνορυı",
        "ABESIJKMHOPCTYXaesijopcyxdqwABEZHIKMNOPTYXaiknopui",
        strict=True,
    )
)
_INVISIBLE = frozenset("­​‌‍‎‏⁠﻿")
_SIGNS = {"․": ".", "。": ".", "−": "-"} | {chr(c): "-" for c in range(0x2010, 0x2016)}
_SUSPECT = re.compile(
    "[ ­²³¹ıͰ-ԯ٠-٩۰-۹०-९ -―․ "
    "⁠-ₜ℀-⅏−①-⓿　。﹐-﻿＀-￯\U0001d400-\U0001d7ff]"
)


@lru_cache(maxsize=None)
def _ascii_of(char: str) -> str:
    """The ASCII text a character stands for; the character itself where there is none."""
    if char in _INVISIBLE:
        return ""
    known = LOOKALIKES.get(char) or _SIGNS.get(char)
    if known:
        return known
    digit = unicodedata.decimal(char, None)
    if digit is not None:
        return str(int(digit))
    if char.isspace():
        return " "
    plain = unicodedata.normalize("NFKC", char)
    plain = "".join(LOOKALIKES.get(c, c) for c in plain)
    return plain if plain.isascii() and not plain.isspace() else char


Edit = tuple[int, int, str]


def lookalike_edits(text: str) -> list[Edit]:
    edits = [(m.start(), m.end(), _ascii_of(m.group())) for m in _SUSPECT.finditer(text)]
    return [edit for edit in edits if text[edit[0]] != edit[2]]


# The digits 0 to 9 in the corpus languages.
DIGIT_WORDS = {
    word: str(value)
    for names in (
        "zero one two three four five six seven eight nine",
        "zéro un deux trois quatre cinq six sept huit neuf",
        "cero uno dos tres cuatro cinco seis siete ocho nueve",
        "null eins zwei drei vier fünf sechs sieben acht neun",
    )
    for value, word in enumerate(names.split())
}


def _in_either_case(words) -> str:
    """Alternatives for words in capitals or not; a class for each letter, so that ``lower`` gives the word back."""
    return "|".join("".join(f"[{c}{c.upper()}]" for c in word) for word in sorted(words, key=lambda w: (-len(w), w)))


_DIGIT_WORD = _in_either_case(DIGIT_WORDS)
_POINT_WORD = _in_either_case(("dot", "point", "punto", "punkt"))
_PLUS_WORD = _in_either_case(("plus", "más", "mas"))
LEAST_DIGIT_WORDS = 3
_DIGIT_RUN = re.compile(
    rf"(?<!\w)(?:(?:{_PLUS_WORD})[\x20]++)?(?:{_DIGIT_WORD}|[0-9]++)"
    rf"(?:(?:[\x20\t]++(?:{_POINT_WORD})[\x20\t]++|[\x20\t]*+[,-][\x20\t]*+|[\x20\t]++)(?:{_DIGIT_WORD}|[0-9]++)(?!\w))+"
)
_RUN_PART = re.compile(rf"(?P<word>{_DIGIT_WORD})(?!\w)|(?P<number>[0-9]+)|(?P<plus>{_PLUS_WORD})|(?P<point>{_POINT_WORD})")
_TOKEN = re.compile(r"\w+")


def may_spell_digits(text: str) -> bool:
    """Whether a text has as many digit words as a run needs. In a run they stand between characters that are in no word."""
    return sum(map(DIGIT_WORDS.__contains__, _TOKEN.findall(text.lower()))) >= LEAST_DIGIT_WORDS


def digit_edits(text: str) -> list[Edit]:
    """Runs of at least three digit words become digits, with the separators between them removed."""
    edits: list[Edit] = []
    if not may_spell_digits(text):
        return edits
    for run in _DIGIT_RUN.finditer(text):
        parts = list(_RUN_PART.finditer(text, run.start(), run.end()))
        if sum(part.lastgroup == "word" for part in parts) < LEAST_DIGIT_WORDS:
            continue
        for left, right in zip([None, *parts], parts):
            # Only between words: figures keep the space or hyphen beside them.
            if left and left.end() < right.start() and "number" not in (left.lastgroup, right.lastgroup):
                edits.append((left.end(), right.start(), ""))
            kind = right.lastgroup
            if kind != "number":
                value = {"plus": "+", "point": "."}.get(kind) or DIGIT_WORDS[right.group().lower()]
                edits.append((right.start(), right.end(), value))
    return edits


# Possessive repetitions: no stretch of blanks or brackets is looked at twice, however long it is.
_IN_BRACKETS = re.compile(
    r"(?:[\[({<][\x20\t]*+(?P<sign>at|@|dot|d0t|\.)[\x20\t]*+[\])}>]++|(?P<escape>&(?:#64|#46|commat|period);|%40))[\x20\t]*+",
    re.IGNORECASE | re.ASCII,
)
_SPOKEN = re.compile(
    r"(?<=[\x20\t])at[\x20\t]++([A-Za-z0-9-]++(?:[\x20\t]++dot[\x20\t]++[A-Za-z0-9-]++)++)", re.IGNORECASE | re.ASCII
)
_SPOKEN_DOT = re.compile(r"[\x20\t]++dot[\x20\t]++", re.IGNORECASE | re.ASCII)
# What a match cannot be without: the characters it may begin with, and the word between blanks.
_MAY_BRACKET = re.compile(r"[\[({<&%]")
_MAY_SPEAK = re.compile(r"[\x20\t][dD][oO][tT][\x20\t]")
_SIGN_OF = {"at": "@", "@": "@", "&#64;": "@", "&commat;": "@", "%40": "@"}
_BLANKS, _OPENING = frozenset(" \t"), frozenset("[({<")
_NAME = _LOCAL_PART - {"."}


def _back(text: str, at: int, floor: int, allowed: frozenset) -> int:
    """The start of the run of ``allowed`` characters that ends at ``at``, not before ``floor``."""
    while at > floor and text[at - 1] in allowed:
        at -= 1
    return at


def _bracketed_edits(text: str) -> Iterator[Edit]:
    floor = 0
    for found in _IN_BRACKETS.finditer(text):
        start = found.start()
        if found.group("sign"):
            start = _back(text, start, floor, _OPENING)
        floor, start = found.end(), _back(text, start, floor, _BLANKS)
        yield start, floor, _SIGN_OF.get((found.group("sign") or found.group("escape")).lower(), ".")


def _spoken_edits(text: str) -> Iterator[Edit]:
    floor = 0
    for found in _SPOKEN.finditer(text):
        start = _back(text, found.start(), floor, _BLANKS)
        if start > floor and text[start - 1] in _LOCAL_PART:
            yield start, found.start(1), "@"
            for dot in _SPOKEN_DOT.finditer(text, found.start(1), found.end(1)):
                yield dot.start(), dot.end(), "."
            left = _back(text, start, floor, _LOCAL_PART)
            while True:  # the local part's own dots
                dot_end = _back(text, left, floor, _BLANKS)
                dot_start = _back(text, max(dot_end - 3, floor), floor, _BLANKS)
                name = _back(text, dot_start, floor, _NAME)
                if dot_end == left or text[max(dot_end - 3, floor) : dot_end].lower() != "dot" or dot_start == dot_end - 3 or name == dot_start:
                    break
                yield dot_start, left, "."
                left = name
        # What comes before the host's first name can be no part of another address.
        floor = found.start(1)


def sign_edits(text: str) -> list[Edit]:
    """``(at)``, ``[dot]`` and character references always; bare words only in ``name at host dot tld``."""
    edits: list[Edit] = []
    if _MAY_BRACKET.search(text):
        edits += _bracketed_edits(text)
    if _MAY_SPEAK.search(text):
        edits += _spoken_edits(text)
    edits.sort()
    kept: list[Edit] = []
    for edit in edits:
        if not kept or edit[0] >= kept[-1][1]:
            kept.append(edit)
    return kept


TRANSDUCERS = (lookalike_edits, digit_edits, sign_edits)


class Normalised(NamedTuple):
    """A rewritten text; character i stands for source characters ``start[i]`` to ``end[i]``, ``touched[i]`` if edited."""

    text: str
    start: np.ndarray
    end: np.ndarray
    touched: np.ndarray


def _apply(state: Normalised, edits: list[Edit]) -> Normalised:
    text, pieces, starts, ends, marks, at = state.text, [], [], [], [], 0
    for begin, stop, new in edits:
        pieces += (text[at:begin], new)
        starts += (state.start[at:begin], np.full(len(new), state.start[begin]))
        ends += (state.end[at:begin], np.full(len(new), state.end[stop - 1]))
        marks += (state.touched[at:begin], np.ones(len(new), bool))
        at = stop
    parts = [[*x, y[at:]] for x, y in ((starts, state.start), (ends, state.end), (marks, state.touched))]
    return Normalised("".join(pieces) + text[at:], *(np.concatenate(x) for x in parts))


def normalise(text: str) -> Normalised | None:
    """The text after all transducers; None when none of them changes it."""
    state = None
    for edits_of in TRANSDUCERS:
        edits = edits_of(state.text if state else text)
        if edits:
            places = np.arange(len(text) + 1)
            state = state or Normalised(text, places[:-1], places[1:], np.zeros(len(text), bool))
            state = _apply(state, edits)
    return state


def find(text: str | None) -> tuple[list[Span], list[Span]]:
    """Plain spans, and all spans: the plain ones and those that normalisation brings to light.

    A found span that an edit contributes to, or that crosses a removed character, is added unless a plain span of its
    kind already covers it. Null and empty texts have no spans.
    """
    if not text:
        return [], []
    plain = plain_spans(text)
    state = normalise(text)
    if state is None:
        return plain, plain
    own = {kind: [span for span in plain if span.kind == kind] for kind in KINDS}
    starts = {kind: [span.start for span in spans] for kind, spans in own.items()}
    added = []
    for kind, begin, stop in plain_spans(state.text):
        start, end = int(state.start[begin]), int(state.end[stop - 1])
        if not state.touched[begin:stop].any() and end - start == stop - begin:
            continue
        # Plain spans of a kind do not overlap, so only the last that starts no later can cover this one.
        before = bisect_right(starts[kind], start) - 1
        if before < 0 or own[kind][before].end < end:
            added.append(Span(kind, start, end))
    return plain, ordered([*plain, *added])


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def redact(text: str | None) -> str | None:
    """Replace each identifier by its kind in brackets; overlapping spans become one, named after the first."""
    if not text:
        return text
    _, spans = find(text)
    if not spans:
        return text
    pieces, at = [], 0
    for span in spans:
        if span.start >= at:
            pieces += (text[at : span.start], f"[{span.kind.upper()}]")
        at = max(at, span.end)
    return "".join(pieces) + text[at:]


# --- On tables

SPAN_TYPE = "array<struct<kind:string,start:bigint,end:bigint>>"


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``pii_plain`` and ``pii_spans``: arrays of (kind, start, end) in code points of the whole text.

    Null and empty texts give empty arrays; repeated rows are each searched; an empty table stays empty; other columns
    pass through untouched. Columns already called ``pii_plain`` or ``pii_spans`` are replaced. No shuffle.
    """
    wanted = docs.drop("pii_plain", "pii_spans")
    struct = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Batches) -> Batches:
        for batch in batches:
            found = [find(x) for x in texts_of(batch, text)]
            arrays = [pa.array([[s._asdict() for s in spans[i]] for spans in found], struct) for i in (0, 1)]
            yield with_columns(batch, dict(zip(("pii_plain", "pii_spans"), arrays)))

    new = StructType.fromDDL(f"pii_plain {SPAN_TYPE}, pii_spans {SPAN_TYPE}")
    return wanted.mapInArrow(run, StructType([*wanted.schema.fields, *new.fields]))


def redact_pii(docs: DataFrame, text: str = "text", size: str = "n_chars") -> DataFrame:
    """``docs`` with identifiers replaced by ``[KIND]`` and ``size``, where there is such a column, counted anew.

    Null texts stay null and keep their size; empty texts, repeated rows, an empty table and all other columns stay as they
    are. A column called like ``size`` that holds no whole numbers is such another column.
    """
    counted = isinstance(docs.schema[size].dataType, IntegralType) if size in docs.columns else False

    def run(batches: Batches) -> Batches:
        for batch in batches:
            before = texts_of(batch, text)
            after = [redact(x) for x in before]
            new = {text: pa.array(after, pa.string())}
            if counted:
                old = batch.column(batch.schema.get_field_index(size))
                counts = [n if b == a else len(a) for n, b, a in zip(old.to_pylist(), before, after)]
                new[size] = pa.array(counts, old.type)
            yield with_columns(batch, new)

    return docs.mapInArrow(run, docs.schema)


def digest_columns(docs: DataFrame) -> DataFrame:
    """Counts per kind of the plain spans, their digest, and all spans as text, per ``doc_id``."""

    def as_text(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("pii_plain", lambda s: s["kind"] == kind)).cast("bigint")

    return docs.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(as_text("pii_plain"), 256).alias("base_sha256"),
        as_text("pii_spans").alias("spans"),
    )
