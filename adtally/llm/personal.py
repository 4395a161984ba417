"""Personal data by anchor expansion.

One pass of an Aho-Corasick automaton over a text finds anchors: at-signs, plus signs, digits, schemes and cues of
identifiers. At each anchor a small parser reads to the left and right as far as its kind of value goes, and checks
what it has read. Only A-Z are lowered for cues, so places are those of the text itself.

Four base kinds follow fixed forms, leftmost first and without overlap within a kind; what fails its check is dropped,
and the search goes on behind it:

  email  letters, digits, `._%+-`, an at-sign, and two or more labels of letters, digits and hyphens
  ip     four numbers joined by dots, each 255 at most
  card   16 to 19 digits, single spaces or hyphens between them, with a right Luhn sum
  phone  a plus sign and 8 to 15 digits; spaces, dots, brackets and hyphens between them

The other kinds come from cues, schemes and wider alphabets. They are added where no base span overlaps them; the first
and the login may overlap one:

  email_intl     an address with letters beyond ASCII, of which the base form sees a part at most
  email_spelled  an address with (at), [at] or {at} for the sign, and (dot), [dot], {dot} or . for dots
  login          the part before the at-sign in scheme://user:password@host
  tel            7 to 15 digits after tel: or sms:
  ipv6           eight groups of up to four hex digits, or fewer with :: and at least three groups
  iban           an account number of 15 to 34 letters and digits after the cue iban, with a right mod-97 sum
  account        an identifier with 6 to 24 letters and digits, at least five of them digits, after account, acct, konto,
                 cuenta, compte, passport, passeport, pasaporte, ssn, social security or tax id (with number, no, nr, # or
                 a colon in between)

A bare scheme without a login, a user name behind an at-sign without a domain, and tokens of machines are no personal
data here.

Nulls and edge cases: a null or empty text has no spans. Repeated rows give repeated results; a null doc_id is passed
on. An empty table gives an empty one. A very long text is read whole, in one pass. Only doc_id and text are read; other
columns are not passed on by ``find`` and stay with ``redact``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.llm.common import raw_texts, slices

#: Base kinds in the order of reports, then added kinds.
BASE = ("email", "ip", "card", "phone")
ADDED = ("email_intl", "email_spelled", "login", "tel", "ipv6", "iban", "account")
KINDS = BASE + ADDED
#: Added kinds that may overlap base spans.
OVERLAPPING = ("email_intl", "login")

# Characters of the base forms.
DIGITS = frozenset("0123456789")
LABEL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-")
LOCAL = LABEL | frozenset("._%+")
HEX = frozenset("0123456789abcdefABCDEF")

#: Cues before an identifier, lowered.
CUES = (
    "account", "acct", "konto", "cuenta", "compte", "passport", "passeport", "pasaporte", "ssn", "social security", "tax id",
)
#: What may stand between a cue and its value.
_BRIDGE = re.compile(r"[ \t]{0,3}(?:(?:number|num|nummer|no|nr|id|n°)(?![a-z])\.?)?[ \t]{0,3}[:#=]?[ \t]{0,3}")
#: Parts of letters and digits, each with a digit after four letters at most.
_PART = r"(?=[A-Za-z]{0,4}[0-9])[A-Za-z0-9]{1,60}+(?![A-Za-z0-9])"
_IDENTIFIER = re.compile(rf"{_PART}(?:[ -]{_PART}){{0,20}}+")
_IBAN = re.compile(r"[A-Za-z]{2}[0-9]{2}(?: ?[A-Za-z0-9]){11,30}+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*+")
_SPACED = re.compile(r"[0-9](?:[ -]?[0-9])*+")
_CALLED = re.compile(r"[ ().0-9-]*+")
_SPELLED_DOMAIN = re.compile(
    r" {0,2}([A-Za-z0-9-]{1,63}(?:(?: {0,2}[(\[{]dot[)\]}] {0,2}|\.)[A-Za-z0-9-]{1,63})+)", re.IGNORECASE
)

_AT, _PLUS, _DIGIT, _SPELLED, _LOGIN, _TEL, _COLONS, _IBAN_CUE, _CUE = range(9)


def _automaton() -> ahocorasick.Automaton:
    """Each pattern's parser and length."""
    out = ahocorasick.Automaton()
    patterns = {"@": _AT, "+": _PLUS, "://": _LOGIN, "tel:": _TEL, "sms:": _TEL, "iban": _IBAN_CUE}
    patterns |= {d: _DIGIT for d in DIGITS}
    patterns |= {f"{a}at{b}": _SPELLED for a, b in ("()", "[]", "{}")}
    patterns |= {cue: _CUE for cue in CUES}
    patterns |= {f"{c}:": _COLONS for c in "0123456789abcdef"} | {"::": _COLONS}
    for text, parser in patterns.items():
        out.add_word(text, (parser, len(text)))
    out.make_automaton()
    return out


_FOUND: list[ahocorasick.Automaton] = []


def anchors() -> ahocorasick.Automaton:
    """The automaton, built once in a worker."""
    if not _FOUND:
        _FOUND.append(_automaton())
    return _FOUND[0]


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        n = int(digit) << (i & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _left(text: str, at: int, stop: int, allowed: frozenset[str]) -> int:
    while at > stop and text[at - 1] in allowed:
        at -= 1
    return at


def _right(text: str, at: int, allowed: frozenset[str]) -> int:
    end = len(text)
    while at < end and text[at] in allowed:
        at += 1
    return at


def _domain(text: str, at: int, allowed) -> int:
    """End of two or more labels from ``at`` on; -1 if there are none."""
    end = _right(text, at, allowed)
    if end == at:
        return -1
    labels = 1
    while end < len(text) and text[end] == ".":
        after = _right(text, end + 1, allowed)
        if after == end + 1:
            break
        end, labels = after, labels + 1
    return end if labels > 1 else -1


class _Wide:
    """Characters and those beyond ASCII that are letters or digits."""

    def __init__(self, ascii_part: frozenset[str]):
        self.ascii_part = ascii_part

    def __contains__(self, c: str) -> bool:
        return c in self.ascii_part or (c > "\x7f" and c.isalnum())


_WIDE_LOCAL, _WIDE_LABEL = _Wide(LOCAL), _Wide(LABEL)


def _email_intl(text: str, at: int) -> tuple[int, int] | None:
    start, end = _left(text, at, max(0, at - 64), _WIDE_LOCAL), _domain(text, at + 1, _WIDE_LABEL)
    if start == at or end < 0 or text[start:end].isascii():
        return None
    return start, end


def _email_spelled(text: str, start: int, end: int) -> tuple[int, int] | None:
    tail = _SPELLED_DOMAIN.match(text, end)
    first = start
    while first > 0 and start - first < 2 and text[first - 1] == " ":
        first -= 1
    local = _left(text, first, max(0, first - 64), LOCAL)
    return (local, tail.end(1)) if tail and local < first else None


def _login(text: str, start: int, end: int) -> tuple[int, int] | None:
    """user[:password] of an authority."""
    if start == 0 or text[start - 1] not in LABEL:
        return None
    stop = end
    while stop < len(text) and text[stop] not in "/?#@\"'<>" and not text[stop].isspace():
        stop += 1
    good = stop < len(text) and text[stop] == "@" and stop > end and _right(text, stop + 1, LABEL) > stop + 1
    return (end, stop) if good else None


def _tel(text: str, start: int, end: int) -> tuple[int, int] | None:
    if start and text[start - 1].isalnum():
        return None
    stop = _CALLED.match(text, end).end()
    while stop > end and text[stop - 1] not in DIGITS:
        stop -= 1
    return (end, stop) if 7 <= sum(c in DIGITS for c in text[end:stop]) <= 15 else None


_ADDRESS = HEX | {":"}


def _ipv6(text: str, at: int, behind: int) -> tuple[int, int] | None:
    start, end = _left(text, at, behind, _ADDRESS), _right(text, at, _ADDRESS)
    outside = (start and (text[start - 1].isalnum() or text[start - 1] in "._")) or (end < len(text) and text[end].isalnum())
    while end > start and text[end - 1] == ":" and text[end - 2 : end] != "::":
        end -= 1
    value = text[start:end]
    if outside or len(value) > 39:
        return None
    groups = [g for part in value.split("::") for g in part.split(":") if part]
    shaped = value.count("::") <= 1 and ":::" not in value and all(1 <= len(g) <= 4 for g in groups)
    full = len(groups) == 8 if "::" not in value else 3 <= len(groups) <= 7
    return (start, end) if shaped and full else None


def _iban(text: str, lowered: str, start: int, end: int) -> tuple[int, int] | None:
    if start and text[start - 1].isalnum():
        return None
    begin = _BRIDGE.match(lowered, end).end()
    found = _IBAN.match(text, begin)
    if not found:
        return None
    # the longest part that ends at a boundary and has a right sum
    stop = found.end()
    while stop > begin:
        value = text[begin:stop].replace(" ", "").upper()
        if len(value) < 15:
            return None
        whole = stop == len(text) or not text[stop].isalnum()
        if whole and text[stop - 1] != " " and int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1:
            return begin, stop
        stop -= 1
    return None


def _account(text: str, lowered: str, start: int, end: int) -> tuple[int, int] | None:
    if start and text[start - 1].isalnum():
        return None
    begin = _BRIDGE.match(lowered, end).end()
    if begin == end:
        return None
    found = _IDENTIFIER.match(text, begin)
    if not found:
        return None
    stop = found.end()
    value = [c for c in text[begin:stop] if c.isalnum()]
    good = 6 <= len(value) <= 24 and sum(c in DIGITS for c in value) >= 5
    return (begin, stop) if good else None


def spans(text: str) -> list[tuple[str, int, int]]:
    """Kind, start and end (in characters, end exclusive) of each value, by kind as in KINDS, then start."""
    lowered = text.encode().lower().decode()
    found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    email_end = ip_end = card_end = phone_end = colons_end = 0
    for last, (parser, size) in anchors().iter(lowered):
        start, end = last - size + 1, last + 1
        if parser == _DIGIT:
            if start >= ip_end:
                ip_end = _DOTTED.match(text, start).end()
                parts = text[start:ip_end].split(".")
                at = start
                for i in range(0, len(parts) - len(parts) % 4, 4):
                    four = parts[i : i + 4]
                    stop = at + sum(map(len, four)) + 3
                    if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                        found["ip"].append((at, stop))
                    at = stop + 1
            if start >= card_end:
                card_end = _SPACED.match(text, start).end()
                if card_end - start >= 16:
                    digits = text[start:card_end].replace(" ", "").replace("-", "")
                    if 16 <= len(digits) <= 19 and luhn(digits):
                        found["card"].append((start, card_end))
        elif parser == _AT:
            local, stop = _left(text, start, email_end, LOCAL), _domain(text, end, LABEL)
            if local < start and stop > 0:
                found["email"].append((local, stop))
                email_end = stop
            if wide := _email_intl(text, start):
                found["email_intl"].append(wide)
        elif parser == _PLUS:
            if start >= phone_end and end < len(text) and text[end] in DIGITS:
                stop = _CALLED.match(text, end).end()
                while text[stop - 1] not in DIGITS:
                    stop -= 1
                if stop - end >= 3:
                    phone_end = stop
                    if 8 <= sum(c in DIGITS for c in text[start:stop]) <= 15:
                        found["phone"].append((start, stop))
        elif parser == _COLONS:
            if start >= colons_end:
                if address := _ipv6(text, start, colons_end):
                    found["ipv6"].append(address)
                colons_end = _right(text, end, _ADDRESS)
        elif parser == _SPELLED:
            found["email_spelled"].append(_email_spelled(text, start, end))
        elif parser == _LOGIN:
            found["login"].append(_login(text, start, end))
        elif parser == _TEL:
            found["tel"].append(_tel(text, start, end))
        elif parser == _IBAN_CUE:
            found["iban"].append(_iban(text, lowered, start, end))
        else:
            found["account"].append(_account(text, lowered, start, end))
    base = sorted(span for kind in BASE for span in found[kind])
    out = [(kind, a, b) for kind in BASE for a, b in found[kind]]
    return out + [(kind, a, b) for kind in ADDED for a, b in _apart(found[kind], base, kind)]


def _apart(added: list, base: list[tuple[int, int]], kind: str) -> Iterator[tuple[int, int]]:
    """Added spans in order, without overlap among themselves, and apart from base spans but for OVERLAPPING kinds."""
    before, at, reach = 0, 0, 0
    for start, end in sorted(x for x in added if x):
        if start < before:
            continue
        while at < len(base) and base[at][0] < end:
            reach = max(reach, base[at][1])
            at += 1
        if reach <= start or kind in OVERLAPPING:
            yield start, end
            before = end


FOUND = "doc_id long, spans array<struct<kind: string, start: int, end: int>>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


def _listed(texts: list[bytes]) -> pa.Array:
    rows = [spans(x.decode()) if x else [] for x in texts]
    offsets = [0]
    for row in rows:
        offsets.append(offsets[-1] + len(row))
    every = [span for row in rows for span in row]
    kinds, starts, ends = zip(*every) if every else ((), (), ())
    values = pa.StructArray.from_arrays(
        [pa.array(kinds, pa.string()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], fields=list(_SPAN)
    )
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def find(docs: DataFrame) -> DataFrame:
    """doc_id and the spans of each text. Texts one by one, no shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part["doc_id"], _listed(raw_texts(part["text"]))], ["doc_id", "spans"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, FOUND)


def redact(docs: DataFrame) -> DataFrame:
    """docs with each value in its text replaced by its kind in angle brackets; all other columns as they are.

    Overlapping values are replaced together, by the kind of the one that begins first (of these, the longest).
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = [None if x is None else hidden(x) for x in part["text"].to_pylist()]
                at = part.schema.get_field_index("text")
                yield part.set_column(at, part.schema.field(at), pa.array(texts, part.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)


def hidden(text: str) -> str:
    out, at = [], 0
    for start, end, kind in sorted(((a, b, k) for k, a, b in spans(text)), key=lambda x: (x[0], -x[1])):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def written(listed: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(listed, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
