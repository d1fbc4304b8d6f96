"""Personal data: patterns propose spans, checksums confirm them, context scores them.

Four base kinds (`email`, `ip`, `card`, `phone`) are found leftmost and non-overlapping
per kind; a base match that passes its check always stays, whatever its score. Two more
kinds come from the method: `iban`, confirmed by its country's length and mod-97, and
`account`, 13 to 15 digits passing Luhn, which counts only where context words nearby lift
its score to `THRESHOLD`. Every span has a score: the kind's prior, plus a bonus for a
passed checksum and one for context words within `CONTEXT_CHARS` code points.

Each row is worked on by itself, so the table is never shuffled. All searches take time in
proportion to the text: an address is found from its `@` outwards, and digit patterns only
start where a run of digits starts, so a long run costs one pass.

Defined results: a null text is empty and has no spans; positions are code points, end
exclusive; an empty table gives an empty result. Rows that repeat are scanned alike.
Columns of the input that are not asked for take no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneflow.llm.common import text_or_empty

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "account")
THRESHOLD = 0.5
CONTEXT_CHARS = 48
PRIOR = {"email": 0.6, "ip": 0.4, "card": 0.2, "phone": 0.5, "iban": 0.2, "account": 0.0}
CHECKSUM_BONUS, CONTEXT_BONUS = 0.35, 0.25

# Words that speak for a kind, in the languages of the corpus.
CONTEXT_WORDS = {
    "email": ("email", "e-mail", "mail", "contact", "correo", "courriel", "kontakt"),
    "ip": ("ip", "host", "server", "address", "login", "adresse"),
    "card": ("card", "visa", "mastercard", "credit", "debit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "handy", "appel"),
    "iban": ("iban", "bank", "account", "konto", "compte", "cuenta"),
    "account": ("account", "card", "amex", "konto", "compte", "cuenta", "tarjeta", "karte"),
}
# Length of an IBAN by country.
IBAN_LENGTHS = {
    "AD": 24, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18,
    "EE": 20, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22,
    "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18,
    "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27,
}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_DIGIT = re.compile(r"[0-9]")
_CONTEXT = {
    kind: re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, words)) + r")(?!\w)")
    for kind, words in CONTEXT_WORDS.items()
}
_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)

Span = tuple[str, int, int, float]


def luhn(digits: str) -> bool:
    own = [int(d) for d in reversed(digits)]
    return (sum(own[::2]) + sum(_DOUBLED[d] for d in own[1::2])) % 10 == 0


def mod97(iban: str) -> bool:
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        parts = (p.lstrip("0") for p in m.group().split("."))
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield m.span()


def numbers(text: str, least: int, most: int) -> Iterator[tuple[int, int]]:
    """Runs of digits, singly separated by spaces or hyphens, that pass Luhn."""
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() < least:
            continue
        digits = _only_digits(m.group())
        if least <= len(digits) <= most and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 8 <= len(_only_digits(m.group())) <= 15:
            yield m.span()


def ibans(text: str) -> Iterator[tuple[int, int]]:
    for m in _IBAN.finditer(text):
        length = IBAN_LENGTHS.get(m.group()[:2])
        if length is None:
            continue
        end, seen = m.start(), 0
        while end < m.end() and seen < length:
            seen += text[end] != " "
            end += 1
        whole = end == len(text) or not (text[end].isascii() and text[end].isalnum())
        if seen == length and whole and mod97(text[m.start():end].replace(" ", "")):
            yield m.start(), end


def _scored(text: str, kind: str, start: int, end: int) -> float:
    around = text[max(0, start - CONTEXT_CHARS):start] + " " + text[end:end + CONTEXT_CHARS]
    score = PRIOR[kind] + CHECKSUM_BONUS * (kind in ("card", "iban", "account"))
    return score + CONTEXT_BONUS * (_CONTEXT[kind].search(around.lower()) is not None)


def find_spans(text: str, threshold: float = THRESHOLD) -> list[Span]:
    """All spans of one text, by kind as in `KINDS`, then by start."""
    has_digit = _DIGIT.search(text) is not None
    proposals = (
        ("email", emails(text) if "@" in text else ()),
        ("ip", ips(text) if has_digit else ()),
        ("card", numbers(text, 16, 19) if has_digit else ()),
        ("phone", phones(text) if "+" in text else ()),
        ("iban", ibans(text) if has_digit else ()),
        ("account", numbers(text, 13, 15) if has_digit else ()),
    )
    out = []
    for kind, spans in proposals:
        for start, end in spans:
            score = _scored(text, kind, start, end)
            if kind in BASE_KINDS or score >= threshold:
                out.append((kind, start, end, round(score, 4)))
    return out


_SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
               ("score", pa.float64())])
)


def tag(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document: its id, and `pii`, the spans with kind, start, end, score."""
    id_type = docs.schema[id_col].dataType.simpleString()
    names = [f.name for f in _SPANS.value_type]

    def spans_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [dict(zip(names, span)) for span in find_spans(t, threshold)]
                for t in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, _SPANS)], [id_col, "pii"]
            )

    return docs.select(id_col, text_or_empty(text).alias("_text")).mapInArrow(
        spans_of,
        f"`{id_col}` {id_type}, pii array<struct<kind:string,start:long,end:long,score:double>>",
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets, from the right so
    that positions hold. Of overlapping spans the one that starts first is replaced."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"])))
    start = F.struct(F.lit("").alias("text"), F.lit(0).cast("long").alias("at"))

    def put(state: Column, span: Column) -> Column:
        piece = F.concat(
            state["text"],
            F.substring(text, (state["at"] + 1).cast("int"), (span["start"] - state["at"]).cast("int")),
            F.lit("["), span["kind"], F.lit("]"),
        )
        return F.when(span["start"] < state["at"], state).otherwise(
            F.struct(piece.alias("text"), span["end"].alias("at"))
        )

    return F.aggregate(
        ordered, start, put,
        lambda s: F.concat(s["text"], F.substring(text, (s["at"] + 1).cast("int"), F.length(text))),
    )


def joined(spans: Column) -> Column:
    """Spans as `kind:start:end`, joined by commas."""
    each = F.transform(
        spans,
        lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(each, ",")


def of_kinds(spans: Column, kinds: Sequence[str]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))
