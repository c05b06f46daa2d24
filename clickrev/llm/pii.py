"""Personal data by anchor expansion.

An Aho-Corasick automaton runs once over a text and reports anchors: at-signs, plus
signs, digits, ``://`` and cues of identifiers such as ``password`` or ``AKIA``. From an
anchor a local parser reads outwards, finds the boundaries of the item and validates it:

* ``email``: local part to the left of an at-sign, dotted domain to the right;
* ``ip``: four dotted numbers of at most 255;
* ``card``: 16 to 19 digits, single blanks or hyphens between them, passing Luhn;
* ``phone``: a plus sign and 8 to 15 digits with common separators;
* ``secret``: the value assigned to a cue (``token = "..."``), or an access key id;
* ``account``: the number after a cue such as ``account``, ``iban`` or ``ssn``;
* ``url``: an address whose authority holds a user name or password.

The first four are the base kinds: per kind the leftmost non-overlapping matches, a match
that fails its validation is dropped without another try. Offsets are code points, ends
exclusive. Null or empty text has no spans. All rows are kept, repeated ones too; other
columns pass through ``redact`` and are not read by ``find_spans``.
"""
import re
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickrev.llm.arrow import map_arrow, slices, texts_of

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret", "account", "url")

Span = tuple[str, int, int]

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_ASSIGNED = re.compile(r"""\s*[=:]\s*(["']?)([^\s"']{6,})\1""")
_KEY_ID = re.compile(r"AKIA[0-9A-Z]{16}(?![0-9A-Za-z])")
_IDENTIFIER = re.compile(
    r"[\s:#=.]*(?:[Nn]o|[Nn]r|[Nn]umber)?[\s:#=.]*"
    r"([A-Z]{2}[0-9]{2}(?:[0-9A-Z]{11,30}|(?: [0-9A-Z]{4}){2,7}(?: [0-9A-Z]{1,3})?)(?![0-9A-Za-z])"
    r"|[0-9][0-9 -]{4,}[0-9])"
)
_URL = re.compile(r"://[^\s/@?#\"'<>]+@[^\s\"'<>]+")
_SCHEME = re.compile(r"[A-Za-z0-9+.-]")
_LETTER = re.compile(r"[A-Za-z]")

_SECRET_CUES = ("password", "passwd", "token", "api_key", "apikey", "secret")
_ACCOUNT_CUES = ("account", "iban", "ssn", "passport")
_DIGITS = "0123456789"


def _automaton() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for anchor in ("@", "+", "://", "AKIA", *_DIGITS):
        automaton.add_word(anchor, (anchor, len(anchor)))
    for cue in (*_SECRET_CUES, *_ACCOUNT_CUES):
        kind = "secret" if cue in _SECRET_CUES else "account"
        for form in (cue, cue.capitalize(), cue.upper()):
            automaton.add_word(form, (kind, len(cue)))
    automaton.make_automaton()
    return automaton


_ANCHORS = _automaton()


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def spans_of(text: str) -> list[Span]:
    """All spans, by kind in the order of ``KINDS``, then by start."""
    found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    used = dict.fromkeys(KINDS, 0)  # where the last match of a kind ended, kept or dropped
    last_digit = -2
    for at, (anchor, length) in _ANCHORS.iter(text):
        start = at - length + 1
        if anchor in _DIGITS:
            if last_digit != at - 1:
                _from_number(text, at, found, used)
            last_digit = at
        elif anchor == "@":
            _from_at_sign(text, at, found, used)
        elif anchor == "+":
            if start >= used["phone"] and (match := _PHONE.match(text, start)):
                used["phone"] = match.end()
                if 8 <= len(_NOT_DIGIT.sub("", match[0])) <= 15:
                    found["phone"].append(match.span())
        elif anchor == "://":
            if match := _URL.match(text, start):
                _add(found, used, "url", _scheme_start(text, start, used["url"]), match.end())
        elif anchor == "AKIA":
            if match := _KEY_ID.match(text, start):
                _add(found, used, "secret", *match.span())
        elif anchor == "secret":
            if match := _ASSIGNED.match(text, at + 1):
                _add(found, used, "secret", *match.span(2))
        elif match := _IDENTIFIER.match(text, at + 1):
            _add(found, used, "account", *match.span(1))
    return [(kind, *span) for kind in KINDS for span in sorted(found[kind])]


def _add(found: dict, used: dict, kind: str, start: int, end: int) -> None:
    if start >= used[kind]:
        found[kind].append((start, end))
        used[kind] = end


def _scheme_start(text: str, end: int, left: int) -> int:
    """Where the scheme before ``end`` begins: the first letter of the signs a scheme may hold."""
    start = end
    while start > left and _SCHEME.match(text, start - 1):
        start -= 1
    letter = _LETTER.search(text, start, end)
    return letter.start() if letter else end


def _from_at_sign(text: str, at: int, found: dict, used: dict) -> None:
    domain = _DOMAIN.match(text, at + 1)
    if not domain:
        return
    start, left = at, used["email"]
    while start > left and _LOCAL.match(text, start - 1):
        start -= 1
    if start < at:
        _add(found, used, "email", start, domain.end())


def _from_number(text: str, start: int, found: dict, used: dict) -> None:
    """Items that begin with the run of digits at ``start``."""
    if start >= used["ip"] and (match := _IP.match(text, start)):
        used["ip"] = match.end()
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in match[0].split(".")):
            found["ip"].append(match.span())
    if start >= used["card"] and (match := _CARD.match(text, start)):
        used["card"] = match.end()
        digits = _NOT_DIGIT.sub("", match[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found["card"].append(match.span())


def joined(spans: Iterable[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def redacted(text: str, spans: Iterable[Span]) -> str:
    """The text with each span, or run of overlapping spans, replaced by ``[KIND]``."""
    parts, done = [], 0
    for start, end, kind in sorted((start, -end, kind) for kind, start, end in spans):
        end = -end
        if start >= done:
            parts += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*parts, text[done:]])


_SPANS_SCHEMA = ", ".join(
    ["doc_id BIGINT", *[f"n_{kind} BIGINT" for kind in BASE_KINDS], "base_spans STRING", "spans STRING"]
)


def find_spans(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): counts of the base kinds, base spans and all spans.

    Spans are ``kind:start:end``, joined by commas. No shuffle.
    """

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            every = [spans_of(text) for text in texts_of(batch)]
            base = [[span for span in spans if span[0] in BASE_KINDS] for spans in every]
            counts = [
                pa.array([sum(span[0] == kind for span in spans) for spans in base], pa.int64())
                for kind in BASE_KINDS
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *counts,
                    pa.array(map(joined, base), pa.string()),
                    pa.array(map(joined, every), pa.string()),
                ],
                ["doc_id", *[f"n_{kind}" for kind in BASE_KINDS], "base_spans", "spans"],
            )

    return map_arrow(
        docs.withColumn("doc_id", F.col("doc_id").cast("long")), ["doc_id", "text"], find, _SPANS_SCHEMA
    )


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind; a null text stays null.

    Keeps rows and columns; a column ``n_chars`` is brought up to date.
    """

    def replace(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            place = batch.schema.get_field_index(text)
            new = [
                value and redacted(value, spans_of(value))
                for value in batch.column(place).to_pylist()
            ]
            yield batch.set_column(place, batch.schema.field(place), pa.array(new, batch.schema.field(place).type))

    result = docs.mapInArrow(replace, docs.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        length = F.coalesce(F.length(text), F.col("n_chars"))
        result = result.withColumn("n_chars", length.cast(kind))
    return result


def op8_anchor_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    found = find_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        "doc_id",
        *[f"n_{kind}" for kind in BASE_KINDS],
        F.sha2("base_spans", 256).alias("base_sha256"),
        "spans",
    )
