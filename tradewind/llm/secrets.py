"""Secret scans with structural confirmation.

Three plain patterns (assignments, access ids, long hex runs) are reported as they stand.
Beyond them, candidates that could be encoded keys or signed tokens are decoded, and are
reported only if what they hold has the structure of one:

- ``jwt``: three dot-separated parts whose first decodes to a JSON object with an ``alg``
  and whose second decodes to a JSON object;
- ``key``: base64 (in PEM armour or bare) or hex that decodes to a private key: DER whose
  nested lengths fill the bytes exactly (PKCS#1, DSA, PKCS#8, SEC1), or the OpenSSH container
  whose length-prefixed fields do. Line breaks may be escaped (as in JSON and .env files),
  hex may have a 0x prefix, and bare base64 may be wrapped over lines.

Texts are independent of each other, so this is one pass without a shuffle.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tradewind.llm.common import id_out, texts

#: Order of kinds where spans begin together.
KINDS = ("assign", "access", "hex", "jwt", "key")
BASE_KINDS = KINDS[:3]

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

TOKEN = re.compile(r"(?<![A-Za-z0-9_-])e[wy][A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
#: Armour; header lines (as of traditional encrypted keys) may come before the body.
ARMOUR = re.compile(
    r"-----BEGIN ([A-Z ]*)PRIVATE KEY-----((?:\s|\\+[nrt])*(?:[A-Z][A-Za-z-]{1,30}: [\x20-\x5b\x5d-\x7e]{1,200}(?:\\+[nr]|\r?\n)+)*)"
    r"((?:[A-Za-z0-9+/=\s]|\\+[nrt])+)-----END \1PRIVATE KEY-----"
)
BARE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}={0,2}")
#: Line breaks, real or escaped.
BREAK = re.compile(r"(?:\\+[nrt]|\s)+")
#: Bare base64 over at least two lines; a line is one run, and the last may be short.
WRAPPED = re.compile(
    r"(?:(?<![A-Za-z0-9+/_\\-])|(?<=\\[nrt]))[A-Za-z0-9+/_-]{16,}(?:(?:\\+r)?(?:\\+n|\r?\n)[\x20\t]*[A-Za-z0-9+/_-]+)+={0,2}"
)
LINE = re.compile(r"(?:\\+r)?(?:\\+n|\r?\n)[\x20\t]*")
#: Fixed value: base64 of the first bytes of the OpenSSH container.
OPENSSH, MAGIC = "b3BlbnNzaC1rZXktdjEA", b"openssh-key-v1\0"

Span = tuple[int, int, str]


def _decoded(text: str) -> bytes | None:
    """Base64 of either alphabet, padding optional; None where it is not base64."""
    text = text.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _json_object(part: str) -> dict | None:
    raw = _decoded(part)
    try:
        value = json.loads(raw.decode("utf-8")) if raw else None
    except (UnicodeDecodeError, ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def is_signed_token(text: str) -> bool:
    header, payload, signature = text.split(".")
    head = _json_object(header)
    if head is None or not isinstance(head.get("alg"), str) or _json_object(payload) is None:
        return False
    return bool(signature) or head["alg"].lower() == "none"


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """(tag, content) of the items that fill the bytes exactly, else None."""
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size == 0x80 or size > 0x84:
            return None
        if size > 0x80:
            width = size & 0x7F
            if at + width > len(data):
                return None
            size, at = int.from_bytes(data[at : at + width], "big"), at + width
        if at + size > len(data):
            return None
        items.append((tag, data[at : at + size]))
        at += size
    return items


#: The encoded object ids of password-based encryption (PKCS#5, PKCS#12).
ENCRYPTIONS = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))
#: ASN.1 tags.
INTEGER, OCTETS, OBJECT_ID, SEQUENCE = 0x02, 0x04, 0x06, 0x30


def is_private_key(data: bytes | None) -> bool:
    """Whether the bytes are a private key in DER or in the OpenSSH container."""
    if not data or len(data) < 30:
        return False
    if data.startswith(MAGIC):
        fields, at = 0, len(MAGIC)
        while at + 4 <= len(data):
            size = int.from_bytes(data[at : at + 4], "big")
            if fields == 3:  # a number of keys, not a length
                size = 0
            at, fields = at + 4 + size, fields + 1
        return at == len(data) and fields >= 6
    if data[0] != SEQUENCE:
        return False
    outer = der_items(data)
    if not outer or len(outer) != 1:
        return False
    inner = der_items(outer[0][1])
    tags = [tag for tag, _ in inner or ()]
    if tags == [SEQUENCE, OCTETS]:  # an encrypted key: the way of encryption, then the bytes
        way = der_items(inner[0][1])
        return bool(way) and way[0][0] == OBJECT_ID and way[0][1].startswith(ENCRYPTIONS) and len(inner[1][1]) >= 16
    if not inner or inner[0][0] != INTEGER or len(inner[0][1]) != 1:
        return False
    if len(tags) >= 9 and set(tags[:9]) == {INTEGER}:
        return True
    if tags == [INTEGER] * 6 and inner[0][1] == b"\0":  # DSA: version, p, q, g, public, private
        return True
    if len(tags) >= 2 and tags[1] == OCTETS and inner[0][1] == b"\1":
        return len(inner[1][1]) in range(20, 73)
    if len(tags) >= 3 and tags[1] == SEQUENCE and tags[2] == OCTETS:
        algorithm = der_items(inner[1][1])
        return bool(algorithm) and algorithm[0][0] == OBJECT_ID
    return False


def _is_encoded_key(run: str) -> bool:
    """Whether an unbroken run is base64 or hex (0x before it or not) of a private key."""
    if is_private_key(_decoded(run)):
        return True
    digits = run[2:] if run[:2] in ("0x", "0X") else run
    try:
        return len(digits) % 2 == 0 and is_private_key(bytes.fromhex(digits))
    except ValueError:
        return False


def _size_of(data: bytes) -> int:
    """Bytes that the DER key which begins here says it has, 0 where none begins."""
    if len(data) < 6 or data[0] != SEQUENCE:
        return 0
    if data[1] < 0x80:
        return 2 + data[1]
    width = data[1] & 0x7F
    return 2 + width + int.from_bytes(data[2 : 2 + width], "big") if width <= 4 else 0


def _wrapped_keys(text: str) -> Iterator[tuple[int, int]]:
    """Spans of keys whose base64 goes over several lines without armour.

    A key may begin at any line; its own length says how many lines it takes.
    """
    for m in WRAPPED.finditer(text):
        lines, at = [], m.start()
        for gap in LINE.finditer(text, m.start(), m.end()):
            lines.append((at, gap.start()))
            at = gap.end()
        lines.append((at, m.end()))
        i = 0
        while i < len(lines) - 1:
            end = _key_end(text, lines, i)
            if end is None:
                i += 1
            else:
                yield lines[i][0], lines[end][1]
                i = end + 1


def _key_end(text: str, lines: list[tuple[int, int]], i: int) -> int | None:
    """The line that ends the key beginning with line i, if one does and takes several.

    Lines are joined only as far as the key's own sizes ask for.
    """
    first = text[slice(*lines[i])]
    if not first.startswith(("M", OPENSSH[:16])):
        return None
    left = lines[-1][1] - lines[i][0]
    joined, size, k, need = [], 0, i, 32
    while True:
        while k < len(lines) and size < need:
            joined.append(text[slice(*lines[k])])
            size, k = size + len(joined[-1].rstrip("=")), k + 1
        start = "".join(joined).rstrip("=")
        if not start.startswith(("M", OPENSSH)):
            return None
        asked, known = _asked(_decoded(start[: len(start) // 4 * 4]) or b"")
        if not 0 < asked * 4 // 3 <= left:
            return None
        if known:
            break
        if k == len(lines):
            return None
        need = max(2 * size, -(-asked * 4 // 3))
    need, size, k = -(-asked * 4 // 3), 0, i
    while k < len(lines) and size < need:
        size, k = size + len(text[slice(*lines[k])].rstrip("=")), k + 1
    whole = "".join(text[x:y] for x, y in lines[i:k])
    return k - 1 if k - i > 1 and is_private_key(_decoded(whole)) else None


def _asked(data: bytes) -> tuple[int, bool]:
    """Bytes that the beginning of a key asks for by the sizes it holds, and whether that is
    all of the key."""
    if not data.startswith(MAGIC):
        return _size_of(data), True
    at, left, fields = len(MAGIC), 4, 0
    while fields < left:
        if at + 4 > len(data):
            return at + 4, False
        size = int.from_bytes(data[at : at + 4], "big")
        if fields == 3:  # a number of public keys; one block of private keys follows them
            left, size = left + size + 1, 0
        at, fields = at + 4 + size, fields + 1
    return at, True


def find_spans(text: str) -> list[Span]:
    """(start, end, kind) in code points, ordered by start, then kind."""
    spans: list[Span] = []
    for m in ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= 6:
            spans.append((m.start(), m.end(), "assign"))
    for kind, pattern in (("access", ACCESS), ("hex", HEX)):
        spans += [(*m.span(), kind) for m in pattern.finditer(text)]
    spans += [(*m.span(), "jwt") for m in TOKEN.finditer(text) if is_signed_token(m[0])]
    armoured: list[Span] = []
    if "-----BEGIN" in text:
        for m in ARMOUR.finditer(text):
            body = _decoded(BREAK.sub("", m[3]))
            # A traditional encrypted key tells its cipher in a header; its body is whole blocks.
            ciphered = "ENCRYPTED" in m[2] and "DEK-Info:" in m[2] and bool(body) and len(body) % 8 == 0
            if ciphered or is_private_key(body):
                armoured.append((*m.span(), "key"))
    spans += armoured
    held = list(armoured)
    for begin, end in _wrapped_keys(text):
        if not any(a < end and begin < b for a, b, _ in held):
            held.append((begin, end, "key"))
            spans.append(held[-1])
    for m in BARE.finditer(text):
        # An escaped line break ends in a letter that is not the run's.
        escaped = m[0][0] in "nrt" and text[max(0, m.start() - 1)] == "\\"
        begins = [m.start() + 1, m.start()] if escaped else [m.start()]
        if any(a <= begins[0] and m.end() <= b for a, b, _ in held):
            continue
        spans += [(at, m.end(), "key") for at in begins if _is_encoded_key(text[at : m.end()])][:1]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


SPANS = "doc_id long, spans array<struct<kind: string, start: long, end: long>>"


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) for every row of docs; a null or empty text has no spans.

    Spans may overlap between kinds, not within one. Repeated rows give equal results.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            found = [
                [{"kind": k, "start": a, "end": b} for a, b, k in find_spans(text.as_py())]
                for text in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, kind)], ["doc_id", "spans"]
            )

    return texts(docs).mapInArrow(run, SPANS).withColumn("doc_id", id_out("doc_id"))
