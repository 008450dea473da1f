"""Personal data: regular expressions propose spans, validators confirm them, context adjusts a score.

Offsets count code points. Every pattern is searched from the left without overlaps; failing matches
are dropped and not tried again, except that an IBAN may end at any earlier end of a word. A pattern that begins with a run of characters is only started where
the run starts, which gives the same matches and keeps the search linear in long runs.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmine.llm.wordhash import slices

CONTEXT_CHARS = 48
THRESHOLD = 0.5
CONTEXT_BONUS = 0.3


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


class Kind(NamedTuple):
    """``guard`` names the characters of the leading run; ``score`` is what a valid match starts with."""

    name: str
    pattern: str
    guard: str
    needs: str
    valid: Callable[[str], bool]
    score: float
    context: frozenset[str]
    base: bool


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def luhn(text: str) -> bool:
    """Luhn check over the digits of ``text``, 12 to 19 of them."""
    digits = _digits(text)
    if not 12 <= len(digits) <= 19:
        return False
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def mod97(text: str) -> bool:
    """IBAN check: country and check digits moved to the end, letters as 10 to 35, remainder 1."""
    compact = text.replace(" ", "")
    if not 15 <= len(compact) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1


def ip_parts(text: str) -> bool:
    parts = [part.lstrip("0") for part in text.split(".")]
    return all(len(part) <= 3 and int(part or "0") <= 255 for part in parts)


def _social(text: str) -> bool:
    area, group, serial = text.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


# The base patterns, and the words near a span that support its kind.
KINDS = [
    Kind("email", r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "A-Za-z0-9._%+-", "@",
         lambda t: True, 0.9, frozenset("email mail e-mail contact address".split()), True),
    Kind("ip", r"[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "0-9", ".",
         ip_parts, 0.7, frozenset("ip host server address login".split()), True),
    Kind("card", r"[0-9]([\x20-]?[0-9])+", "", "",
         luhn, 0.8, frozenset("card visa mastercard credit debit payment".split()), True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "", "+",
         lambda t: 9 <= len(_digits(t)) <= 15, 0.6, frozenset("phone tel call mobile fax whatsapp".split()), True),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])", "", "",
         mod97, 0.6, frozenset("iban account bank konto compte cuenta".split()), False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "", "-",
         _social, 0.3, frozenset("ssn social security".split()), False),
]
# Length of the IBANs of each country in the registry; others have 15 to 34 characters.
IBAN_LENGTHS = {
    code[:2]: int(code[2:])
    for code in """
    AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20
    EG29 ES24 FI18 FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30
    KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23
    PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26
    UA29 VA22 VG24 XK20 YE30
    """.split()
}
_ORDER = {kind.name: i for i, kind in enumerate(KINDS)}
_PLAIN = {kind.name: re.compile(kind.pattern) for kind in KINDS}
_GUARDED = {
    kind.name: re.compile(f"(?<![{kind.guard}])" + kind.pattern) if kind.guard else _PLAIN[kind.name]
    for kind in KINDS
}
_DIGIT = re.compile("[0-9]")
_WORD = re.compile("[A-Za-z-]+")


def _next_start(kind: Kind, match: re.Match, end: int | None) -> int:
    """Where the search goes on. What an over-long IBAN match ran into may hold another one."""
    if kind.name != "iban":
        return match.end()
    return end if end is not None else match.start() + 1


def _matches(kind: Kind, text: str) -> Iterator[tuple[int, int]]:
    """``(start, end)`` of the valid matches."""
    plain, guarded, at = _PLAIN[kind.name], _GUARDED[kind.name], 0
    while True:
        # Right after a match a new one may start inside a run.
        match = (at and plain.match(text, at)) or guarded.search(text, at)
        if not match:
            return
        end = next((e for e in _ends(kind, match) if kind.valid(text[match.start() : e])), None)
        if end is not None:
            yield match.start(), end
        at = _next_start(kind, match, end)


def _ends(kind: Kind, match: re.Match) -> Iterator[int]:
    """Ends to try: that of the match; for an IBAN those of its words, from long to short.

    A country's IBANs have one length, so of a listed country only that end is tried.
    """
    if kind.name != "iban":
        yield match.end()
        return
    found = match.group()
    length = IBAN_LENGTHS.get(found[:2])
    at = len(found)
    while at >= 0:
        if length is None or len(found[:at].replace(" ", "")) == length:
            yield match.start() + at
        at = found.rfind(" ", 0, at)


def _near(text: str, start: int, end: int) -> set[str]:
    """Words that lie whole within some characters before or after a span."""
    low, high = max(0, start - CONTEXT_CHARS), min(len(text), end + CONTEXT_CHARS)
    # A character more on either side shows whether the word there goes on.
    first, last = max(0, low - 1), min(len(text), high + 1)
    before = [m for m in _WORD.finditer(text, first, start) if m.start() >= low]
    after = [m for m in _WORD.finditer(text, end, last) if m.end() <= high]
    return {m.group().lower() for m in before + after}


def find_spans(text: str, threshold: float = THRESHOLD) -> list[Span]:
    """Spans of one text, by start, then kind as listed. Base kinds stay whatever their score."""
    spans = []
    digits = _DIGIT.search(text) is not None
    for kind in KINDS:
        if (kind.needs and kind.needs not in text) or (kind.name != "email" and not digits):
            continue
        for start, end in _matches(kind, text):
            score = kind.score
            if kind.context & _near(text, start, end):
                score = min(1.0, score + CONTEXT_BONUS)
            if kind.base or score >= threshold:
                spans.append(Span(kind.name, start, end, round(score, 3)))
    return sorted(spans, key=lambda s: (s.start, _ORDER[s.kind], s.end))


SCHEMA = "spans array<struct<kind: string, start: int, end: int, score: double>>"


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
    )
    for batch in batches:
        for part in slices(batch, 1):
            found = [[s._asdict() for s in find_spans(t)] for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, kind)], ["doc_id", "spans"])


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, spans)``: one row per row of ``docs``, in one pass without a shuffle.

    ``spans`` holds ``kind, start, end, score``. Null and empty texts have no spans, null ids and
    repeated rows keep a row each, other columns are ignored. Kinds may overlap each other. Base kinds
    are email, ip, card and phone; the checksum method adds iban, context words add ssn.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(_find, f"doc_id {kind}, {SCHEMA}")


def mask(text: str, spans: list[Span]) -> str:
    """``text`` with every span replaced by its kind; of overlapping spans the first one is replaced."""
    out, at = [], 0
    for span in spans:
        if span.start >= at:
            out += [text[at : span.start], f"<{span.kind}>"]
            at = span.end
    return "".join([*out, text[at:]])
