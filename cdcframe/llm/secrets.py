"""Secret scan with structural confirmation.

Patterns alone report too much. A base64 or hex candidate is reported as a key only if its bytes parse as one, with every
nested length right; a dotted token only if its header and payload are the JSON that a signed or encrypted token has.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: In the order in which spans with the same start are listed.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "signed_token", "private_key")
MASK = "[REDACTED]"

_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])e[wy][A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{4,}(?:\.[A-Za-z0-9_-]*){1,3}")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[MbL][A-Za-z0-9+/_-]{39,}={0,2}")
_HEX_KEY = re.compile(r"(?<![0-9A-Fa-f])(?:30|6[Ff]70|2[Dd]2[Dd])[0-9A-Fa-f]{44,}")
_LABEL = re.compile(r"-----BEGIN ([A-Z0-9 ]{1,60})-----")
_OPENSSH = b"openssh-key-v1\0"

_INTEGER, _OCTETS, _OID, _SEQUENCE = 0x02, 0x04, 0x06, 0x30


def _value(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the DER value at a place; None if it does not fit or its length is not in the shortest form."""
    if at + 2 > end:
        return None
    tag, length, at = data[at], data[at + 1], at + 2
    if length >= 0x80:
        n = length & 0x7F
        if not 1 <= n <= 4 or at + n > end:
            return None
        length, at = int.from_bytes(data[at : at + n], "big"), at + n
        if length < 0x80 or length >> (8 * (n - 1)) == 0:
            return None
    return (tag, at, at + length) if at + length <= end else None


def _parts(data: bytes, at: int, end: int) -> list[tuple[int, int, int]]:
    """The values that fill a stretch exactly; none if they do not."""
    found = []
    while at < end:
        if (value := _value(data, at, end)) is None:
            return []
        found.append(value)
        at = value[2]
    return found


def _der_key(data: bytes) -> bool:
    whole = _value(data, 0, len(data))
    if whole is None or whole[0] != _SEQUENCE or whole[2] != len(data):
        return False
    parts = _parts(data, whole[1], whole[2])
    tags = [part[0] for part in parts]
    if len(tags) < 2:
        return False
    if tags[:3] == [_INTEGER, _SEQUENCE, _OCTETS]:  # a key with the name of its algorithm
        algorithm = _parts(data, *parts[1][1:])
        inner = _value(data, *parts[2][1:])
        return bool(algorithm) and algorithm[0][0] == _OID and inner is not None and inner[2] == parts[2][2]
    if tags == [_SEQUENCE, _OCTETS]:  # an encrypted one
        algorithm = _parts(data, *parts[0][1:])
        return len(algorithm) == 2 and algorithm[0][0] == _OID and parts[1][2] - parts[1][1] >= 16
    if set(tags) == {_INTEGER} and len(tags) in (6, 9):  # DSA, RSA
        return data[parts[0][1] : parts[0][2]] in (b"\0", b"\1") and all(b - a >= 1 for _, a, b in parts)
    if tags[:2] == [_INTEGER, _OCTETS]:  # elliptic curve
        sized = 16 <= parts[1][2] - parts[1][1] <= 72
        return sized and data[parts[0][1] : parts[0][2]] == b"\1" and set(tags[2:]) <= {0xA0, 0xA1}
    return False


def _openssh_key(data: bytes) -> bool:
    if not data.startswith(_OPENSSH):
        return False
    at = len(_OPENSSH)

    def field() -> bytes | None:
        nonlocal at
        length = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + length > len(data) or len(data) < at + 4:
            return None
        at += 4 + length
        return data[at - length : at]

    names = [field() for _ in range(3)]
    if None in names or not names[0] or len(data) < at + 4:
        return False
    keys, at = int.from_bytes(data[at : at + 4], "big"), at + 4
    if not 1 <= keys <= 16:
        return False
    return all(field() for _ in range(keys)) and bool(field()) and at == len(data)


def _base64(text: str) -> bytes | None:
    text = text.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _key(data: bytes | None) -> bool:
    """Whether bytes are a private key, or a text block that holds one."""
    if not data:
        return False
    if data.startswith(b"-----BEGIN "):
        return bool(_blocks(data.decode("latin-1")))
    return _der_key(data) or _openssh_key(data)


def _blocks(text: str) -> list[tuple[int, int]]:
    """Text blocks of private keys whose content parses."""
    found, at = [], 0
    while (stop := text.find("-----END ", at)) >= 0:
        start = text.rfind("-----BEGIN ", at, stop)
        label = _LABEL.match(text, start) if start >= 0 else None
        closing = f"-----END {label[1]}-----" if label else ""
        if label and label.end() <= stop and text.startswith(closing, stop):
            body = text[label.end() : stop].replace("\\n", "\n").replace("\\r", "\n")
            lines = [line.strip(" \t\r\"'") for line in body.split("\n")]
            data = _base64("".join(line for line in lines if ":" not in line))
            encrypted = label[1].endswith("PRIVATE KEY") and any("ENCRYPTED" in line for line in lines if ":" in line)
            if _der_key(data or b"") or _openssh_key(data or b"") or (encrypted and data and len(data) % 8 == 0):
                found.append((start, stop + len(closing)))
        at = stop + 9
    return found


def _json(segment: str) -> dict | None:
    data = _base64(segment)
    try:
        value = json.loads(data) if data else None
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def _signed(token: str) -> int:
    """The length of the signed or encrypted token at the start of dotted base64 segments; 0 if there is none."""
    segments = token.split(".")
    header = _json(segments[0])
    if header is None or not isinstance(header.get("alg"), str):
        return 0
    if isinstance(header.get("enc"), str):
        return len(".".join(segments[:5])) if len(segments) == 5 and all(_base64(s) for s in segments[2:]) else 0
    signed = bool(segments[2]) and bool(_base64(segments[2]))
    if _json(segments[1]) is None or not (signed or header["alg"].lower() == "none"):
        return 0
    return len(".".join(segments[:3]))


def find_spans(text: str | None) -> list[tuple[str, int, int]]:
    """Kind, start and end (code points, end exclusive) of all secrets of a text, in order."""
    text = text or ""
    found: set[tuple[int, int, int]] = set()
    low = text.lower()
    if any(word in low for word in _WORDS):
        found |= {(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6}
    if "AKIA" in text:
        found |= {(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)}
    found |= {(m.start(), 2, m.end()) for m in _HEX.finditer(text)}
    if "." in text:
        for m in _TOKEN.finditer(text):
            if length := _signed(m[0]):
                found.add((m.start(), 3, m.start() + length))
    blocks = _blocks(text)
    keys = set(blocks)
    keys |= {m.span() for m in _BASE64.finditer(text) if _key(_base64(m[0]))}
    keys |= {m.span() for m in _HEX_KEY.finditer(text) if len(m[0]) % 2 == 0 and _key(bytes.fromhex(m[0]))}
    found |= {(a, 4, b) for a, b in keys if not any(x <= a and b <= y and (a, b) != (x, y) for x, y in blocks)}
    return [(KINDS[kind], start, end) for start, kind, end in sorted(found)]


def mask(text: str | None) -> str | None:
    """The text with every stretch of secrets replaced, until a scan finds no more: a gap may set a candidate free."""
    while text and (spans := find_spans(text)):
        out, at = [], 0
        for _, start, end in spans:  # by start
            if start >= at:
                out += [text[at:start], MASK]
            at = max(at, end)
        text = "".join(out) + text[at:]
    return text


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def scan_secrets(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: the id and `spans`, an array of (kind, start, end) by start, then kind.

    A NULL or empty text has no spans. Rows that repeat are each reported; other columns are not carried, so their names
    cannot clash. Nothing is shuffled.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [
                [{"kind": kind, "start": start, "end": end} for kind, start, end in find_spans(value)]
                for value in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _SPANS)], names=[id, "spans"])

    kind = docs.schema[id].dataType.simpleString()
    schema = f"`{id}` {kind}, spans array<struct<kind: string, start: int, end: int>>"
    return docs.select(id, text).mapInArrow(scan, schema)


def mask_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """The same rows and columns, with secrets in one column replaced. NULL stays NULL."""
    names = docs.columns
    at = names.index(text)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.columns
            columns[at] = pa.array([mask(value) for value in columns[at].to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(apply, docs.schema)


def spans_text(spans) -> F.Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(scanned: DataFrame) -> DataFrame:
    """Counts of the base spans, the SHA-256 of their text and the text of all spans."""
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    return scanned.select(
        "doc_id", *counts, F.sha2(spans_text(base), 256).alias("base_sha256"), spans_text(F.col("spans")).alias("spans")
    )
