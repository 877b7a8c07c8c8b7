"""Personal data by anchor expansion: Aho-Corasick finds anchors, small parsers find the bounds around them.

Anchors are at-signs, "://", a plus before a digit, digits next to digits (also across a dot, a space or
a hyphen) and cue words. Each parser looks only at the text around its anchor, so a text is read once.
Base kinds are email, ip, card and phone, as their patterns say; the method adds the others.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from txnrisk.llm.common import in_slices, map_arrow, sha256_hex, texts

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "iban", "account", "secret", "address")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_SCHEME = re.compile(r"(?<![A-Za-z0-9])(https?|ftps?|sftp|ssh)\Z", re.I)
_URL_REST = re.compile(r"[^\s<>\"'`{}|\\^]+")
_IBAN = re.compile(r"[:#]?[ ]?(?:(?:no|number|nr)[.:]?[ ])?([A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
_ACCOUNT = re.compile(r"[ ]?(?:(?:no|number|nr|num)\b[.:]?)?[ ]?[:#=]?[ ]?([0-9][0-9 -]{4,22}[0-9])(?![A-Za-z0-9])")
_SECRET = re.compile(r"[ ]?[:=][ ]?[\"']?([A-Za-z0-9_+/.=-]{8,})")
_ADDRESS = re.compile(r"(?<![A-Za-z0-9])[0-9]{1,5}[A-Za-z]?,?[ ](?:[A-Z][A-Za-z'.-]*[ ]){1,4}\Z")
#: Cue words (fixed values), found in lower case, with a capital and in capitals.
CUES = {
    "iban": ("iban",),
    "account": ("account", "acct", "ssn", "passport", "routing"),
    "secret": ("password", "passwd", "token", "api_key", "apikey", "api-key", "secret"),
    "address": ("street", "avenue", "road", "boulevard", "lane", "drive"),
}


def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    digits = "0123456789"
    found.add_word("@", ("email", 1))
    found.add_word("://", ("url", 3))
    for a in digits:
        found.add_word(f"+{a}", ("phone", 2))
        for b in digits:
            found.add_word(f"{a}.{b}", ("ip", 3))
            for gap in ("", " ", "-"):
                found.add_word(f"{a}{gap}{b}", ("card", 2 + len(gap)))
    for kind, cues in CUES.items():
        for cue in cues:
            for form in {cue, cue.capitalize(), cue.upper()}:
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


_ANCHORS: list = []


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _email(text: str, at: int, free: int) -> tuple[int, int, bool] | None:
    start = at
    while start > free and text[start - 1] in _LOCAL:
        start -= 1
    rest = _DOMAIN.match(text, at + 1) if start < at else None
    return rest and (start, rest.end(), True)


def _ip(text: str, at: int, free: int) -> tuple[int, int, bool] | None:
    start = at
    while start > free and text[start - 1] in "0123456789":
        start -= 1
    found = _IP.match(text, start)
    # Parts are compared without leading zeros, by length first: a part may be very long.
    return found and (start, found.end(), all(len(p := part.lstrip("0")) < 4 and int(p or 0) <= 255 for part in found[0].split(".")))


def _card(text: str, at: int, free: int) -> tuple[int, int, bool] | None:
    found = _CARD.match(text, at)
    digits = _NOT_DIGIT.sub("", found[0])
    return at, found.end(), 14 <= len(digits) <= 19 and _luhn(digits)


def _phone(text: str, at: int, free: int) -> tuple[int, int, bool] | None:
    found = _PHONE.match(text, at)
    return found and (at, found.end(), 10 <= len(_NOT_DIGIT.sub("", found[0])) <= 15)


def _url(text: str, at: int, free: int) -> tuple[int, int, bool] | None:
    scheme = _SCHEME.search(text[max(0, at - 6) : at])
    rest = _URL_REST.match(text, at + 3)
    if not scheme or not rest:
        return None
    end = at + 3 + len(rest[0].rstrip(".,;:!?)]*&%$#"))
    return (at - len(scheme[0]), end, True) if end > at + 3 else None


def _iban(text: str, at: int, free: int) -> tuple[int, int, bool] | None:
    found = _IBAN.match(text, at + 4)
    if not found:
        return None
    code = found[1].replace(" ", "")
    number = "".join(str(int(c, 36)) for c in code[4:] + code[:4])
    return found.start(1), found.end(1), 15 <= len(code) <= 34 and int(number) % 97 == 1


def _cued(pattern: re.Pattern):
    def parse(text: str, at: int, free: int, length: int) -> tuple[int, int, bool] | None:
        if at and (text[at - 1].isalnum() or text[at - 1] in "_-"):
            return None
        found = pattern.match(text, at + length)
        return found and (found.start(1), found.end(1), True)

    return parse


def _address(text: str, at: int, free: int, length: int) -> tuple[int, int, bool] | None:
    end = at + length
    if not text[at].isupper() or end < len(text) and text[end].isalnum():
        return None
    low = max(free, at - 100)
    found = _ADDRESS.search(text[low:at])
    return found and (low + found.start(), end, True)


_PARSERS = {"email": _email, "ip": _ip, "card": _card, "phone": _phone, "url": _url, "iban": _iban}
_CUED = {"account": _cued(_ACCOUNT), "secret": _cued(_SECRET), "address": _address}


def spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind as listed in ``KINDS``.

    Matches of a kind don't overlap: what an earlier one took, also one that failed its check, is not
    looked at again for that kind.
    """
    if not _ANCHORS:
        _ANCHORS.append(_automaton())
    free, found = dict.fromkeys(KINDS, 0), []
    for last, (kind, length) in _ANCHORS[0].iter(text):
        at = last - length + 1
        if at < free[kind]:
            continue
        parser = _PARSERS.get(kind)
        span = parser(text, at, free[kind]) if parser else _CUED[kind](text, at, free[kind], length)
        if span:
            free[kind] = span[1]
            if span[2]:
                found.append((kind, span[0], span[1]))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _joined(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        every = [spans(t) for t in batch.column(1).to_pylist()]
        base = [[s for s in own if s[0] in BASE] for own in every]
        counts = [pa.array([sum(s[0] == kind for s in own) for own in base], pa.int64()) for kind in BASE]
        columns = [batch.column(0), *counts, pa.array([sha256_hex(_joined(own)) for own in base], pa.string()), pa.array([_joined(own) for own in every], pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans"])


def report(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, counts of the base kinds, hash of the base spans, all spans.

    A null text is empty and has no spans; repeated rows stay; other columns aren't read.
    """
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return map_arrow(texts(docs), _report, schema)


def masked(text: str) -> str:
    """The text with each span replaced by its kind in angle brackets; of spans that overlap, the first names all."""
    out, at, found = [], 0, spans(text)
    k = 0
    while k < len(found):
        kind, start, end = found[k]
        k += 1
        while k < len(found) and found[k][1] < end:
            end = max(end, found[k][2])
            k += 1
        out += [text[at:start], f"<{kind.upper()}>"]
        at = end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns; personal data in ``text`` is masked, and ``n_chars``, if there, follows.

    A null text stays null.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            new = [t if t is None else masked(t) for t in batch.column("text").to_pylist()]
            columns = {c: batch.column(k) for k, c in enumerate(batch.schema.names)}
            columns["text"] = pa.array(new, pa.string())
            if "n_chars" in columns:
                counts = pa.array([old if t is None else len(t) for t, old in zip(new, columns["n_chars"].to_pylist())], pa.int64())
                columns["n_chars"] = counts.cast(columns["n_chars"].type)
            yield pa.RecordBatch.from_pydict(columns)

    return map_arrow(docs, work, docs.schema)
