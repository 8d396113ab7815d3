"""Operator 8: secrets found by pattern and confirmed by their structure.

Base spans come from three patterns (assign, access, hex). The method then decodes every base64 or hex run and
reports it only if the bytes parse: DER with nested lengths that end where they should, an OpenSSH key
container, SSH wire fields, or a signed token whose header is JSON with an algorithm.

Defined cases: a null text counts as empty (no spans, the hash of the empty string). Rows are scanned one by
one, so ties, repeated rows and null ids need nothing; an empty table gives an empty result. Positions are code
points, end exclusive, over the whole text however long.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re

from pyspark.sql import DataFrame

# Fixed patterns of the base kinds.
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a maximal run of 16 or more is the same match as a longer-than-15 [0-9a-f]+

KINDS = ("assign", "access", "hex", "der", "openssh", "ssh", "jwt")
RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}={0,2}")
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]{1,40})-----([A-Za-z0-9+/=\s]+)-----END \1-----")
JWT = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the three base kinds, in order."""
    found = []
    low = text.lower()
    if any(h in low for h in HINTS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def decode64(run: str) -> bytes:
    run = re.sub(r"[\s=]", "", run).replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(run + "=" * (-len(run) % 4), validate=True)
    except (binascii.Error, ValueError):
        return b""


def der_end(data: bytes, at: int) -> tuple[int, int, int] | None:
    """(tag, start of content, end) of the DER element at a position, if its length is well formed and fits."""
    if at + 2 > len(data):
        return None
    size, begin = data[at + 1], at + 2
    if size & 0x80:
        n = size & 0x7F
        if not 1 <= n <= 4 or begin + n > len(data) or data[begin] == 0:
            return None
        size, begin = int.from_bytes(data[begin : begin + n], "big"), begin + n
        if size < 0x80:
            return None
    return (data[at], begin, begin + size) if begin + size <= len(data) else None


def is_der_key(data: bytes) -> bool:
    """A sequence that fills the data, whose nested lengths all fit and which holds a number, bits or bytes."""
    top = der_end(data, 0)
    if len(data) < 24 or not top or top[0] != 0x30 or top[2] != len(data):
        return False
    ranges, leaves = [(top[1], top[2])], 0
    while ranges:
        at, end = ranges.pop()
        while at < end:
            got = der_end(data[:end], at)
            if not got:
                return False
            tag, begin, at = got
            if tag & 0x20:
                ranges.append((begin, at))
            elif tag in (0x02, 0x03, 0x04, 0x06) and at > begin:
                leaves += 1
            elif tag not in (0x01, 0x05, 0x0C, 0x13, 0x16, 0x17, 0x18) and not tag & 0x80:
                return False
    return leaves >= 2


def ssh_fields(data: bytes, at: int = 0) -> list[bytes] | None:
    """Length-prefixed fields that end exactly with the data."""
    fields = []
    while at < len(data):
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data):
            return None
        fields.append(data[at + 4 : at + 4 + size])
        at += 4 + size
    return fields


def structure(data: bytes) -> int | None:
    """The kind index that decoded bytes confirm."""
    if data.startswith(b"openssh-key-v1\0"):
        at, size = 15, -1
        for _ in range(3):  # cipher, key derivation, its options
            size = int.from_bytes(data[at : at + 4], "big")
            at += 4 + size
        return KINDS.index("openssh") if at + 4 <= len(data) else None
    if data[:3] == b"\0\0\0":
        fields = ssh_fields(data)
        if fields and len(fields) > 1 and re.fullmatch(rb"(ssh|ecdsa|sk)-[a-z0-9@.-]+", fields[0]):
            return KINDS.index("ssh")
    return KINDS.index("der") if data[:1] == b"\x30" and is_der_key(data) else None


def is_signed_token(text: str) -> bool:
    try:
        head, _, rest = text.partition(".")
        header, body = json.loads(decode64(head)), json.loads(decode64(rest.partition(".")[0]))
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str) and isinstance(body, dict)


def confirmed_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of what decodes and parses."""
    found = []
    if "-----BEGIN " in text:
        for m in PEM.finditer(text):
            kind = structure(decode64(m[2]))
            if kind is not None:
                found.append((m.start(), kind, m.end()))
    if "eyJ" in text:
        found += [(m.start(), KINDS.index("jwt"), m.end()) for m in JWT.finditer(text) if is_signed_token(m[0])]
    for m in RUN.finditer(text):
        run = m[0]
        kind = structure(decode64(run))
        if kind is None and len(run) % 2 == 0 and re.fullmatch(r"[0-9A-Fa-f]+", run):
            kind = structure(bytes.fromhex(run))
        if kind is not None:
            found.append((m.start(), kind, m.end()))
    return found


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of docs: key, n_assign, n_access, n_hex, n_confirmed, base, spans (kind:start:end lists)."""
    kind = dict(docs.dtypes)[key]
    schema = f"{key} {kind}, n_assign long, n_access long, n_hex long, n_confirmed long, base string, spans string"

    def scan(batches):
        import pyarrow as pa

        for batch in batches:
            rows = []
            for t in batch.column(1):
                t = t.as_py() or ""
                base, more = base_spans(t), confirmed_spans(t)
                count = [sum(1 for _, k, _ in base if k == i) for i in range(3)]
                rows.append((*count, len(more), spans_text(base), spans_text(sorted({*base, *more}))))
            cols = [pa.array([r[i] for r in rows], pa.int64() if i < 4 else pa.string()) for i in range(6)]
            names = ["n_assign", "n_access", "n_hex", "n_confirmed", "base", "spans"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], [key, *names])

    return docs.select(key, text).mapInArrow(scan, schema)


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
