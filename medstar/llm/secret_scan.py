"""Secret scan with structural confirmation.

Plain patterns report three kinds (fixed by the contract): ``assign`` (a name
like ``password`` with a value), ``access`` (an access key id) and ``hex`` (a
long run of hex digits).  What else looks like a secret is only a candidate
until its structure has been parsed:

``private_key``  a PEM block, or a run of base64 or hex digits, whose bytes are
    a private key: DER with every nested length exact and the members that
    PKCS#1, PKCS#8, SEC1, DSA or an encrypted PKCS#8 key must have, or the
    ``openssh-key-v1`` container with its length-prefixed fields; an encrypted
    PEM body (DEK-Info) must be whole cipher blocks;
``signed_token``  three base64url parts of which the first is a JSON object
    with a string ``alg`` other than "none", the second decodes, and the
    signature is as long as that algorithm's;
``wrapped``  a run of base64 or hex digits that decodes to text in which one of
    the above is confirmed (at most ``DEPTH`` times over).

Random base64, hashes, images and unsigned tokens don't parse, so they are not
reported; public keys and certificates parse, but as what they are.

Scale.  One pass over the texts, no shuffle.  Every pattern matches maximal
runs or fixed words, so time is linear in the text: a run is decoded at most
once per alphabet, a PEM head is paired with the next tail only.

Defined results: a null text is an empty one and has no spans; repeated rows
give repeated rows; an empty table gives an empty result; other columns are not
looked at.  Offsets count code points, ends are exclusive.  Spans of different
kinds may overlap; they are ordered by start, then kind as listed in ``KINDS``,
then end.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

KINDS = ["assign", "access", "hex", "private_key", "signed_token", "wrapped"]
BASE_KINDS = KINDS[:3]
_SPANS = "array<struct<kind:string,start:int,end:int>>"
DEPTH, RUN = 3, 40
_NOT_CONTROL = bytes(b for b in range(256) if b >= 32 or b in (9, 10, 13))

# The patterns of the contract.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX_RUN = re.compile(r"[0-9a-f]{32,}")               # the same matches, failing ones left out

_MARK = re.compile(r"-----(BEGIN|END) ((?:[A-Z0-9]+ )*)PRIVATE KEY-----")
_ENCODED = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % RUN)
_PART = re.compile(r"[A-Za-z0-9+/_-]{%d,}" % RUN)
_URL_DIGITS = re.compile(r"[A-Za-z0-9_-]*")
_HEX_ONLY = re.compile(r"[0-9a-fA-F]+\Z")

#: Signature bytes of the registered algorithms (RSA ones: at least).
_SIGNATURE = {"HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES256K": 64, "ES384": 96,
              "ES512": 132, "EdDSA": 64}
_RSA_SIGNATURE, _LEAST_RSA = {"RS256", "RS384", "RS512", "PS256", "PS384", "PS512"}, 128
_INTEGER, _OCTETS, _OID, _SEQUENCE, _PARAMETERS = 0x02, 0x04, 0x06, 0x30, 0xA0


def decoded(run: str) -> bytes | None:
    """Bytes of base64 or base64url digits, padded or not; None if they are
    neither."""
    digits = run.rstrip("=")
    if len(digits) % 4 == 1 or "." in digits or "=" in digits:
        return None
    mixed = digits.translate({0x2D: "+", 0x5F: "/"})
    try:
        return base64.b64decode(mixed + "=" * (-len(mixed) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _members(data: bytes) -> list[tuple[int, bytes]] | None:
    """(tag, content) of DER values that fill ``data`` exactly, else None."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size >= 0x80:
            more = size & 0x7F
            if not 1 <= more <= 4 or at + more > len(data):
                return None
            size, at = int.from_bytes(data[at:at + more], "big"), at + more
            if size < 0x80:                                   # a short length is written short
                return None
        if at + size > len(data):
            return None
        out.append((tag, data[at:at + size]))
        at += size
    return out


def _is_algorithm(content: bytes) -> bool:
    inner = _members(content)
    return bool(inner) and inner[0][0] == _OID and len(inner[0][1]) >= 3


def _is_der_key(data: bytes) -> bool:
    if data[:1] != b"\x30":                                   # a sequence, first of all
        return False
    top = _members(data)
    if not top or len(top) != 1:
        return False
    inner = _members(top[0][1])
    if not inner or len(inner) < 2:
        return False
    tags = [t for t, _ in inner]
    (first, second) = inner[0], inner[1]
    small = first[0] == _INTEGER and len(first[1]) == 1 and first[1][0] <= 1
    if small and len(tags) in (9, 10) and tags[:9] == [_INTEGER] * 9:      # PKCS#1
        modulus, exponent = len(inner[1][1]), len(inner[2][1])
        return modulus >= 32 and 1 <= exponent <= modulus and len(inner[4][1]) >= modulus // 4
    if small and tags == [_INTEGER] * 6:                      # DSA: 0, p, q, g, y, x
        return len(inner[1][1]) >= 64 and len(inner[2][1]) >= 20
    if small and second[0] == _SEQUENCE and len(tags) >= 3 and tags[2] == _OCTETS:   # PKCS#8
        return _is_algorithm(second[1]) and len(inner[2][1]) >= 16
    if first == (_INTEGER, b"\x01") and second[0] == _OCTETS and len(second[1]) in range(16, 67):
        # SEC1: the curve's name and the public point may follow
        return len(tags) > 2 and all(t in (_PARAMETERS, 0xA1) for t in tags[2:])
    # encrypted PKCS#8
    return (tags == [_SEQUENCE, _OCTETS] and _is_algorithm(first[1]) and len(second[1]) >= 32
            and len(second[1]) % 8 == 0)


_OPENSSH = b"openssh-key-v1\0"


def _is_openssh_key(data: bytes) -> bool:
    if not data.startswith(_OPENSSH):
        return False
    at = len(_OPENSSH)

    def field(at: int) -> tuple[bytes, int] | None:
        size = int.from_bytes(data[at:at + 4], "big")
        return (data[at + 4:at + 4 + size], at + 4 + size) if at + 4 + size <= len(data) else None

    for _ in range(3):                                        # cipher, kdf, its options
        if not (got := field(at)):
            return False
        at = got[1]
    keys, at = int.from_bytes(data[at:at + 4], "big"), at + 4
    if not 1 <= keys <= 16:
        return False
    for _ in range(keys + 1):                                 # public keys, the private part
        if not (got := field(at)) or not got[0]:
            return False
        at = got[1]
    return at == len(data)


def is_private_key(data: bytes) -> bool:
    return _is_der_key(data) or _is_openssh_key(data)


def is_signed_token(head: str, body: str, signature: str) -> bool:
    """Whether three base64url parts are a signed token."""
    header, content, sign = decoded(head), decoded(body), decoded(signature)
    if not header or not content or not sign or header[:1] != b"{":
        return False
    try:
        fields = json.loads(header)
    except (ValueError, RecursionError):
        return False
    kind = fields.get("alg") if isinstance(fields, dict) else None
    if not isinstance(kind, str):
        return False
    if kind in _RSA_SIGNATURE:
        return len(sign) >= _LEAST_RSA
    return len(sign) == _SIGNATURE.get(kind, -1)


def _pem_blocks(text: str) -> Iterator[tuple[int, int]]:
    """Spans of confirmed PEM private keys; also with line breaks written as
    a backslash and n, as in JSON."""
    begin = None
    for mark in _MARK.finditer(text):
        if mark[1] == "BEGIN":
            begin = mark
            continue
        if begin is None or begin[2] != mark[2]:
            begin = None
            continue
        body = text[begin.end():mark.start()].replace("\\r", "\n").replace("\\n", "\n")
        lines = [x.strip() for x in body.split("\n")]
        heads = [x for x in lines if ":" in x]
        data = decoded("".join("".join(x for x in lines if ":" not in x).split()))
        if data and (is_private_key(data) or any(x.startswith("DEK-Info:") for x in heads)
                     and len(data) >= 32 and len(data) % 8 == 0):
            yield begin.start(), mark.end()
        begin = None


def _confirmed(text: str, depth: int) -> list[tuple[str, int, int]]:
    blocks = list(_pem_blocks(text)) if "-----BEGIN" in text else []
    out = [("private_key", a, b) for a, b in blocks]
    starts = [a for a, _ in blocks]
    for run in _ENCODED.finditer(text):
        i = bisect(starts, run.start()) - 1
        if i < 0 or run.start() >= blocks[i][1]:              # the body of a block is no run
            out += _run(run[0], run.start(), depth)
    return out


def _run(run: str, start: int, depth: int) -> list[tuple[str, int, int]]:
    """What a maximal run of encoding characters holds."""
    out = _tokens(run, start) if "." in run else []
    if out:
        return out
    for part in _PART.finditer(run):
        # a name and a sign may stand before the value: the run is split there
        if kind := _digits(part[0], depth):
            padding = run[part.end():part.end() + 2]
            end = part.end() + len(padding) - len(padding.lstrip("="))
            out.append((kind, start + part.start(), start + end))
    return out


def _tokens(run: str, start: int) -> list[tuple[str, int, int]]:
    """Signed tokens among each three neighbours of the parts between dots."""
    out, at, parts, free = [], 0, run.split("."), 0
    for i, head in enumerate(parts[:-2]):
        begin = max(head.rfind(c) for c in "=+/") + 1          # a name and a sign before it
        body, signature = parts[i + 1], _URL_DIGITS.match(parts[i + 2])[0]
        if i >= free and is_signed_token(head[begin:], body, signature):
            out.append(("signed_token", start + at + begin,
                        start + at + len(head) + 2 + len(body) + len(signature)))
            free = i + 3
        at += len(head) + 1
    return out


def _digits(digits: str, depth: int) -> str | None:
    """The kind that base64 or hex digits decode to."""
    ways = [decoded(digits)]
    if len(digits) % 2 == 0 and _HEX_ONLY.match(digits):
        ways.append(bytes.fromhex(digits))
    for data in ways:
        if not data:
            continue
        if is_private_key(data):
            return "private_key"
        if depth > 1 and _texty(data):
            try:
                inner = data.decode("utf-8")
            except UnicodeDecodeError:
                continue
            if _confirmed(inner, depth - 1):
                return "wrapped"
    return None


def _texty(data: bytes) -> bool:
    """Whether it may be text: no control characters but white space."""
    return not data.translate(None, _NOT_CONTROL)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = []
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        out += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    out += [("hex", *m.span()) for m in _HEX_RUN.finditer(text)]
    return out


def spans_of(text: str) -> list[tuple[str, int, int]]:
    found = base_spans(text) + _confirmed(text, DEPTH)
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def scan(docs: DataFrame, *keep: str) -> DataFrame:
    """(doc_id, spans) and the columns named in ``keep``: the spans of each
    text as structs (kind, start, end)."""
    entry = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    fields = docs.select("doc_id", *keep).schema
    rows = docs.select("doc_id", *keep, F.col("text").cast("string").alias("__text"))
    names = [*fields.names, "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[{"kind": k, "start": a, "end": b} for k, a, b in spans_of(t.as_py() or "")]
                     for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(spans, pa.list_(entry))], names=names)

    return rows.mapInArrow(run, StructType([*fields, StructField("spans", StructType.fromDDL(f"x {_SPANS}")["x"].dataType)]))


def redacted(docs: DataFrame, mask: str = "[secret]") -> DataFrame:
    """(doc_id, text): the texts with every span replaced by ``mask``;
    overlapping spans are one."""
    def merge(done: Column, s: Column) -> Column:
        behind = s["end"] <= done["at"]
        joined = s["start"] < done["at"]
        return F.when(behind, done).otherwise(F.struct(
            F.concat(done["out"], F.when(joined, F.lit("")).otherwise(F.concat(
                F.substr(F.col("text"), done["at"] + 1, s["start"] - done["at"]), F.lit(mask))))
            .alias("out"), s["end"].alias("at")))

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    text = F.aggregate("spans", start, merge, lambda done: F.concat(
        done["out"], F.substr(F.col("text"), done["at"] + 1)))
    return scan(docs, "text").select("doc_id", F.when(F.col("text").isNotNull(), text).alias("text"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans)."""
    spans = F.col("spans")
    count = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE_KINDS))
    return scan(docs).select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(spans).alias("spans"))
