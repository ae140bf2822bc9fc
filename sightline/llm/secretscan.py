"""Secrets by structure: base64 and hex candidates are decoded and parsed before they are reported.

Three plain patterns give the base spans. All other spans are confirmed by what they hold: DER
private keys whose nested lengths fill the data, OpenSSH keys, PEM blocks around either, signed
tokens with a readable header and a signature of the length its algorithm asks for, and keys that
were encoded once more. Every step is linear in the text: candidates do not overlap, and a whole
candidate is decoded only where the length in its first bytes agrees with its end.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import hashlib
import json
import re
import sys
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sightline.llm.text import map_texts, with_long_id

#: fixed values: kinds in the order in which spans of one start are listed
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "signed_token", "pem_key", "der_key", "ssh_key", "encoded_key")

#: fixed values: the words and patterns of the base spans
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_EITHER = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in n) for n in NAMES)
ASSIGN = re.compile(rf"(?:{_EITHER})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")

#: the shortest encodings of a private key: 48 bytes of an Ed25519 one
LEAST_BASE64, LEAST_HEX = 64, 96
BASE64 = re.compile(rf"[A-Za-z0-9+/_-]{{{LEAST_BASE64},}}")
HEX_RUN = re.compile(rf"[0-9A-Fa-f]{{{LEAST_HEX},}}")
DOTTED = re.compile(r"[A-Za-z0-9_.-]+")
PEM_HEAD = re.compile(r"-----BEGIN ((?:[A-Z0-9]{1,20} ){0,4}PRIVATE KEY)-----")

#: fixed values: bytes of a signature by algorithm; RSA ones take at least 128
SIGNED = {"HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES256K": 64, "ES384": 96, "ES512": 132, "EdDSA": 64}
RSA_SIGNED = ("RS256", "RS384", "RS512", "PS256", "PS384", "PS512")
SSH_MAGIC = b"openssh-key-v1\0"

INTEGER, OCTETS, OID, SEQUENCE = 0x02, 0x04, 0x06, 0x30


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int


def _run_marks(chars: str) -> bytes:
    """A byte table that turns these characters to ``x`` and all others to blanks."""
    return bytes(0x78 if chr(b) in chars else 0x20 for b in range(256))


_ALNUM = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
_HEX_MARKS, _BASE64_MARKS = _run_marks("0123456789abcdef"), _run_marks(_ALNUM + "+/_-")


def decoded(text: str) -> bytes | None:
    """Bytes of base64 in either alphabet, padded or not; None where it is none."""
    plain = text.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the content of the DER element at ``at``; None where it does not fit."""
    if at + 2 > end:
        return None
    tag, size, start = data[at], data[at + 1], at + 2
    if size >= 0x80:
        wide = size & 0x7F
        if not 1 <= wide <= 4 or start + wide > end:
            return None
        size = int.from_bytes(data[start : start + wide], "big")
        start += wide
    return (tag, start, start + size) if start + size <= end else None


def elements(data: bytes, at: int, end: int, most: int = 12) -> list[tuple[int, int, int]] | None:
    """The elements that fill ``data[at:end]`` exactly, at most ``most``."""
    found = []
    while at < end:
        one = element(data, at, end)
        if one is None or len(found) == most:
            return None
        found.append(one)
        at = one[2]
    return found


def _algorithm(data: bytes, one: tuple[int, int, int]) -> bool:
    inner = elements(data, one[1], one[2]) if one[0] == SEQUENCE else None
    return bool(inner) and inner[0][0] == OID and inner[0][1] < inner[0][2]


def der_private_key(data: bytes, at: int = 0) -> bool:
    """Whether ``data`` from ``at`` to its end has the nested lengths and tags of a private key: RSA,
    DSA, EC, PKCS#8 or encrypted PKCS#8."""
    top = element(data, at, len(data))
    if top is None or top[0] != SEQUENCE or top[2] != len(data):
        return False
    parts = elements(data, top[1], top[2])
    if not parts:
        return False
    tags = [tag for tag, _, _ in parts]
    value = lambda one: data[one[1] : one[2]]
    if tags[:2] == [SEQUENCE, OCTETS]:
        return len(tags) == 2 and _algorithm(data, parts[0]) and parts[1][2] - parts[1][1] >= 16
    if tags[0] != INTEGER or value(parts[0]) not in (b"\0", b"\1"):
        return False
    if tags in ([INTEGER] * 9, [INTEGER] * 6):
        return parts[1][2] - parts[1][1] >= 32
    if tags[:2] == [INTEGER, OCTETS]:
        return value(parts[0]) == b"\1" and 16 <= parts[1][2] - parts[1][1] <= 66 and all(t in (0xA0, 0xA1) for t in tags[2:])
    return tags[:3] == [INTEGER, SEQUENCE, OCTETS] and _algorithm(data, parts[1]) and all(t in (0xA0, 0xA1, 0x81) for t in tags[3:])


def ssh_private_key(data: bytes) -> bool:
    """Whether length-prefixed fields of an OpenSSH key fill the data."""
    if not data.startswith(SSH_MAGIC):
        return False
    at = len(SSH_MAGIC)

    def field() -> bool:
        nonlocal at
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at : at + 4], "big")
        return at <= len(data)

    if not (field() and field() and field()) or at + 4 > len(data):
        return False
    keys = int.from_bytes(data[at : at + 4], "big")
    at += 4
    return 1 <= keys <= 16 and all(field() for _ in range(keys + 1)) and at == len(data)


def pem_blocks(text: str) -> list[tuple[int, int, str]]:
    """Start, end and label of the PEM private keys whose body is confirmed."""
    found = []
    for head in PEM_HEAD.finditer(text):
        close = text.find("-----", head.end())  # the next dashes, so no text is searched twice
        foot = f"-----END {head[1]}-----"
        if close < 0 or not text.startswith(foot, close):
            continue
        body = text[head.end() : close].replace("\\r", "").replace("\\n", "\n")
        fields, _, rest = body.strip().rpartition("\n\n")
        locked = "ENCRYPTED" in fields or "DEK-Info" in fields
        data = decoded("".join((rest if locked else body).split()))
        if not data:
            continue
        if der_private_key(data) or ssh_private_key(data) or locked and len(data) >= 64 and len(data) % 8 == 0:
            found.append((head.start(), close + len(foot), head[1]))
    return found


def _object(part: str) -> dict | None:
    data = decoded(part)
    try:
        value = json.loads(data) if data else None
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def signed_tokens(text: str) -> list[tuple[int, int]]:
    """Header, payload and signature joined by dots, where the header names how it was signed."""
    found = []
    for chain in DOTTED.finditer(text):
        parts, at, free = chain[0].split("."), chain.start(), 0
        starts = []
        for part in parts:
            starts.append(at)
            at += len(part) + 1
        for i in range(len(parts) - 2):
            if i < free or not parts[i].startswith("eyJ"):  # the base64 of an opening brace and a quote
                continue
            header = _object(parts[i])
            name = header and header.get("alg")
            if not isinstance(name, str) or name not in SIGNED and name not in RSA_SIGNED:
                continue
            signature = decoded(parts[i + 2])
            size = len(signature or b"")
            if size == SIGNED.get(name, -1) or name in RSA_SIGNED and size >= 128:
                if _object(parts[i + 1]) is not None:
                    found.append((starts[i], starts[i + 2] + len(parts[i + 2])))
                    free = i + 3
    return found


def _confirmed(data: bytes | None) -> str | None:
    if not data:
        return None
    if der_private_key(data):
        return "der_key"
    if ssh_private_key(data):
        return "ssh_key"
    if data.lstrip().startswith(b"-----BEGIN "):
        return "encoded_key" if pem_blocks(data.decode("latin-1")) else None
    return None


def encoded_keys(text: str) -> list[Span]:
    """Keys in runs of base64 or hex: the run from its start, or from where a DER sequence begins
    in it that ends with the run."""
    found = []
    for run in HEX_RUN.finditer(text):
        kind = _confirmed(bytes.fromhex(run[0])) if len(run[0]) % 2 == 0 else None
        if kind:
            found.append(Span(kind, *run.span()))
    for run in BASE64.finditer(text):
        start, end = run.span()
        padding = re.compile("={0,2}").match(text, end).end()
        # one decoding for each of the four places in a group of characters
        shifted = [decoded(run[0][shift:]) or b"" for shift in range(4)]
        kind = _confirmed(shifted[0])
        for place in re.finditer("M(?=[A-I])", run[0]) if kind is None else ():
            group, shift = divmod(place.start(), 4)
            if len(run[0]) - place.start() >= LEAST_BASE64 and der_private_key(shifted[shift], 3 * group):
                kind, start = "der_key", start + place.start()
                break
        if kind:
            found.append(Span(kind, start, padding))
    return found


def _inside(span: Span, blocks: list[tuple[int, int, str]]) -> bool:
    at = bisect.bisect_right(blocks, (span.start, sys.maxsize)) - 1
    return at >= 0 and span.start < blocks[at][1]


def spans_of(text: str | None) -> list[Span]:
    """All spans of a text, by start and then kind. Spans of one kind do not overlap.

    A null or empty text has none. Positions count code points; the end is exclusive. A base span
    covers the whole match. Lone dots, huge runs and deep JSON are handled in linear time.
    """
    if not text:
        return []
    raw = text.encode("utf-8", "surrogatepass")
    low = raw.lower()
    out: list[Span] = []
    if any(name.encode() in low for name in NAMES):
        out += [Span("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    if b"AKIA" in raw:
        out += [Span("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    if b"x" * 24 in raw.translate(_HEX_MARKS):
        out += [Span("hex", *m.span()) for m in HEX.finditer(text)]
    if b"eyJ" in raw:
        out += [Span("signed_token", *s) for s in signed_tokens(text)]
    blocks = pem_blocks(text) if b"-----BEGIN " in raw else []
    out += [Span("pem_key", a, b) for a, b, _ in blocks]
    if b"x" * LEAST_BASE64 in raw.translate(_BASE64_MARKS):
        out += [s for s in encoded_keys(text) if not _inside(s, blocks)]
    order = {kind: i for i, kind in enumerate(KINDS)}
    return sorted(out, key=lambda s: (s.start, order[s.kind], s.end))


def find(docs: DataFrame) -> DataFrame:
    """``doc_id, spans``: an array of (kind, start, end) for every row; further columns are ignored.

    Null and empty texts give an empty array, repeated rows one array each, an empty table no rows.
    """

    def make(texts, kept):
        return kept["doc_id"], [[(s.kind, s.start, s.end) for s in spans_of(t)] for t in texts]

    return map_texts(with_long_id(docs), "text", ["doc_id"], make, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def digest(docs: DataFrame) -> DataFrame:
    """Counts per base kind, the hash of the base spans, and all spans as one string; rows as in :func:`find`."""

    def make(texts, kept):
        counts: dict[str, list] = {kind: [] for kind in BASE_KINDS}
        hashes, listed = [], []
        for text in texts:
            spans = spans_of(text)
            name = [f"{s.kind}:{s.start}:{s.end}" for s in spans]
            for kind in BASE_KINDS:
                counts[kind].append(sum(s.kind == kind for s in spans))
            base = ",".join(n for n, s in zip(name, spans, strict=True) if s.kind in counts)
            hashes.append(hashlib.sha256(base.encode()).hexdigest())
            listed.append(",".join(name))
        return kept["doc_id"], *counts.values(), hashes, listed

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return map_texts(with_long_id(docs), "text", ["doc_id"], make, schema)


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; of overlapping spans the union is replaced."""
    out, at = [], 0
    for span in spans:
        if span.end <= at:
            continue
        if span.start >= at:
            out += [text[at : span.start], f"<{span.kind}>"]
        at = span.end
    return "".join([*out, text[at:]])


def without_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by ``<kind>``; a null text stays null. ``n_chars`` follows."""
    others = [c for c in docs.columns if c != "text"]

    def make(texts, kept):
        return *(kept[c] for c in others), [t and masked(t, spans_of(t)) for t in texts]

    schema = StructType([docs.schema[c] for c in others]).add("text", "string")
    out = map_texts(docs, "text", others, make, schema).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out
