"""Secret scan with structural confirmation.

Base kinds are found by pattern: assignments to secret-like names, access keys,
hex strings.  Beyond these, every base64 and hex candidate is decoded, and reported
only if what it holds is a secret by its structure:

* ``jwt``: three base64url segments whose first two decode to JSON objects, the
  header naming an algorithm and the signature as long as that algorithm's;
* ``private_key``: base64 or hex of a DER sequence whose nested lengths add up and
  which is an RSA, DSA, EC, PKCS#8 or encrypted PKCS#8 private key, or an OpenSSH
  key whose length-prefixed fields add up; or base64 of a text with PEM lines that
  hold one.

Base64 may stand between PEM lines, run over line ends without them, or follow
other characters of its alphabet (a path, a name): a DER value tells its own length,
so one is tried wherever its first bytes can stand, and the span is the key's own
characters.  Traditional encrypted PEM (``Proc-Type`` headers) has no structure to
confirm and is not reported.

Texts are scanned whole, one row at a time, by Arrow batches in the tasks; there
is no shuffle.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import json
import re
from collections.abc import Callable
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("assign", "access", "hex")
KINDS = BASE_KINDS + ("jwt", "private_key")

# Fixed patterns of the base kinds.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")  # 16 characters or more
_HEX = re.compile(r"[0-9a-f]{32,}")
_MIN_VALUE = 8

_DOTTED = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]*){2,}")
_OBJECT = re.compile(r"(?=e[w-z]|[CDI])")  # where a JSON object may begin: the base64 of a brace or blank
_BRACE = re.compile(rb"[\x20\t\r\n]*(?:\{[\x20\t\r\n]*(?:[\"}]|\Z)|\Z)")
_PEM = re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----([A-Za-z0-9+/=\s\\]+)-----END (?:[A-Z0-9]+ )*PRIVATE KEY-----")
_END = r"\\r?\\n|\r?\n|\\n"  # a line end, also written out
_BASE64 = re.compile(rf"[A-Za-z0-9+/]{{32,}}(?:(?:{_END})[\x20\t]*[A-Za-z0-9+/]+)*={{0,2}}")
_BETWEEN = re.compile(rf"(?:{_END})[\x20\t]*")
_MIN_BASE64 = 64
_HEX_RUN = re.compile(r"[0-9a-fA-F]{64,}")
_DER64 = re.compile(r"(?=M[A-I])")  # tag 30 and the first bits of a length
_DER16 = re.compile(r"(?=30[0-8])")
_SIGNATURES = {"HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES384": 96, "ES512": 132, "EDDSA": 64}
_OPENSSH = b"openssh-key-v1\0"
_OPENSSH64 = "b3BlbnNzaC1rZXktdjEA"  # the same 15 bytes
# Password-based encryption: the object identifiers under PKCS#5 and PKCS#12.
_PBE = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))
# The end of a PEM line as it looks in base64, by what precedes it.
_MARK64 = [(base64.b64encode(b"\0" * k + b"PRIVATE KEY-----").decode()[(k * 4 + 2) // 3 :][:18], k) for k in range(3)]


def _unpadded(text: str) -> bytes | None:
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), altchars=b"-_", validate=True)
    except (binascii.Error, ValueError):
        return None


def is_signed_token(text: str) -> bool:
    """Whether header and payload are JSON and the signature fits the header."""
    parts = text.split(".")
    if len(parts) != 3:
        return False
    decoded = [_unpadded(p) for p in parts]
    if None in decoded:
        return False
    try:
        header, payload = json.loads(decoded[0]), json.loads(decoded[1])
    except (ValueError, RecursionError):
        return False
    if not isinstance(header, dict) or not isinstance(payload, dict) or not isinstance(header.get("alg"), str):
        return False
    algorithm, size = header["alg"].upper(), len(decoded[2])
    if algorithm in _SIGNATURES:
        return size == _SIGNATURES[algorithm]
    if algorithm[:2] in ("RS", "PS"):
        return size >= 128
    return algorithm != "NONE" and size > 0


def der(data: bytes, at: int = 0) -> tuple[int, int, int] | None:
    """(tag, start, end) of the contents of the DER value at ``at``."""
    if at + 2 > len(data):
        return None
    tag, size, at = data[at], data[at + 1], at + 2
    if size & 0x80:
        n = size & 0x7F
        if not 1 <= n <= 4 or at + n > len(data):
            return None
        size, at = int.from_bytes(data[at : at + n], "big"), at + n
    return (tag, at, at + size) if at + size <= len(data) else None


def fields(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """The values that fill ``data[start:end]`` exactly, or None."""
    found = []
    while start < end:
        one = der(data[:end], start)
        if one is None or len(found) > 32:
            return None
        found.append(one)
        start = one[2]
    return found


def is_private_key(data: bytes) -> bool:
    """Whether the bytes are a private key whose nested lengths add up."""
    if data.startswith(_OPENSSH):
        return _openssh_size(lambda i: data[i : i + 4]) == len(data)
    outer = der(data)
    if outer is None or outer[0] != 0x30 or outer[2] != len(data):
        return False
    inner = fields(data, outer[1], outer[2])
    if inner and [t for t, _, _ in inner] == [0x30, 0x04]:  # encrypted PKCS#8: scheme and ciphertext
        scheme = fields(data, inner[0][1], inner[0][2])
        return bool(scheme) and scheme[0][0] == 0x06 and data[scheme[0][1] : scheme[0][2]].startswith(_PBE)
    if not inner or inner[0][0] != 0x02 or inner[0][2] - inner[0][1] != 1:
        return False
    version, tags = data[inner[0][1]], [t for t, _, _ in inner]
    if version == 0 and tags == [0x02] * 9:  # RSA: version and eight integers
        return True
    if version == 0 and tags == [0x02] * 6:  # DSA: version, three parameters, two keys
        return all(inner[i][2] - inner[i][1] >= 16 for i in (1, 2, 4))
    if version == 1 and tags[:2] == [0x02, 0x04] and all(t in (0xA0, 0xA1) for t in tags[2:]):  # EC
        return inner[1][2] - inner[1][1] >= 16
    if version in (0, 1) and tags[:3] == [0x02, 0x30, 0x04]:  # PKCS#8: algorithm and key
        algorithm = fields(data, inner[1][1], inner[1][2])
        return bool(algorithm) and algorithm[0][0] == 0x06
    return False


def _decoded_key(text: str) -> bool:
    data = _unpadded(text.rstrip("="))
    return data is not None and is_private_key(data)


def _der_size(head: bytes) -> int | None:
    """Bytes of the DER value that begins with ``head`` (6 bytes)."""
    size = head[1]
    if not size & 0x80:
        return 2 + size
    n = size & 0x7F
    return 2 + n + int.from_bytes(head[2 : 2 + n], "big") if 1 <= n <= 4 else None


def _openssh_size(four: Callable[[int], bytes]) -> int:
    """Bytes of an OpenSSH key (0: none), by the four bytes at its length fields."""
    at = len(_OPENSSH)
    for _ in range(3):  # cipher, KDF, KDF options
        if len(four(at)) < 4:
            return 0
        at += 4 + int.from_bytes(four(at), "big")
    keys = int.from_bytes(four(at), "big")
    if not 1 <= keys <= 8:
        return 0
    at += 4
    for _ in range(keys + 1):  # public keys, then the private part
        if len(four(at)) < 4:
            return 0
        at += 4 + int.from_bytes(four(at), "big")
    return at


def _bytes_of(text: str) -> bytes:
    """What a run of base64 characters holds, as far as it goes."""
    whole = text[: len(text) - (len(text) % 4 == 1)]
    return base64.b64decode(whole + "=" * (-len(whole) % 4))


def _keys_in_base64(text: str, ends: set[int]) -> list[tuple[int, int]]:
    """Where private keys stand in a run of base64 characters (without padding);
    a bare key ends where the run or one of its lines does (``ends``)."""
    found, after = [], 0
    for m in _DER64.finditer(text):
        at = m.start()
        if at < after or at + 8 > len(text):
            continue
        size = _der_size(base64.b64decode(text[at : at + 8]))
        end = at + -(-4 * size // 3) if size else 0
        if end in ends and _decoded_key(text[at:end]):
            found.append((at, end))
            after = end
    at = text.find(_OPENSSH64)
    while at >= 0:
        # only the groups of four characters that hold a length are decoded
        size = _openssh_size(lambda i: _bytes_of(text[at + i // 3 * 4 : at + i // 3 * 4 + 8])[i % 3 : i % 3 + 4])  # noqa: B023
        end = at + -(-4 * size // 3)
        if size and end in ends:
            found.append((at, end))
        at = text.find(_OPENSSH64, at + 1)
    for mark, shift in _MARK64:
        at = text.find(mark)
        if at >= 0:  # a text with PEM lines, at this alignment
            first = (at - (shift * 4 + 2) // 3) % 4
            decoded = _bytes_of(text[first:]).decode("latin-1")
            found += [(first + m.start() * 4 // 3, first + -(-m.end() * 4 // 3)) for m in _PEM.finditer(decoded) if _pem_key(m)]
    return found


def _pem_key(m: re.Match) -> bool:
    return _decoded_key(re.sub(r"\\[nr]|[\s\\]", "", m.group(1)))


def _tokens_in(text: str) -> list[tuple[int, int]]:
    """Where signed tokens stand among segments set apart by dots."""
    segments, at = [], 0
    for part in text.split("."):
        segments.append((at, part))
        at += len(part) + 1
    found = []
    for (at, header), (_, payload), (last, signature) in zip(segments, segments[1:], segments[2:]):
        if len(header) < 12 or len(payload) < 2 or (found and at < found[-1][1]):
            continue
        for m in _OBJECT.finditer(header):
            # most places are none by their first bytes
            if _BRACE.match(_bytes_of(header[m.start() : m.start() + 64])) and is_signed_token(f"{header[m.start() :]}.{payload}.{signature}"):
                found.append((at + m.start(), last + len(signature)))
                break
    return found


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base kinds, by kind as listed, then start."""
    found = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= _MIN_VALUE]
    found += [("access", *m.span()) for m in _ACCESS.finditer(text)] if "AKIA" in text else []
    return found + [("hex", *m.span()) for m in _HEX.finditer(text)]


def confirmed_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of candidates that decode to a secret's structure."""
    found = []
    for m in _DOTTED.finditer(text):
        found += [("jwt", m.start() + a, m.start() + b) for a, b in _tokens_in(m.group())]
    pem = [m.span() for m in _PEM.finditer(text) if _pem_key(m)] if "PRIVATE KEY-----" in text else []
    found += [("private_key", *s) for s in pem]
    starts = [a for a, _ in pem]

    def inside(a: int, b: int) -> bool:
        k = bisect.bisect_right(starts, a) - 1
        return k >= 0 and b <= pem[k][1]

    for m in _BASE64.finditer(text):
        if m.end() - m.start() < _MIN_BASE64 or inside(*m.span()):
            continue
        # the run without its line ends: where each line begins, in it and in the text
        lines, at = [], m.start()
        for gap in _BETWEEN.finditer(text, *m.span()):
            lines.append((at, text[at : gap.start()]))
            at = gap.end()
        lines.append((at, text[at : m.end()].rstrip("=")))
        begins = list(accumulate((len(line) for _, line in lines), initial=0))

        def place(i: int) -> int:
            k = bisect.bisect_right(begins, i) - 1
            return lines[k][0] + i - begins[k]

        for a, b in _keys_in_base64("".join(line for _, line in lines), set(begins[1:])):
            end, pad = place(b - 1) + 1, -(b - a) % 4
            end += pad if text[end : end + pad] == "=" * pad else 0
            found.append(("private_key", place(a), end))
    for m in _HEX_RUN.finditer(text):
        digits, at = m.group().lower(), 0
        places = [d.start() for d in _DER16.finditer(digits)] + [digits.find(_OPENSSH.hex())]
        for at in places:
            if at < 0 or (len(digits) - at) % 2 or inside(m.start() + at, m.end()):
                continue
            head = bytes.fromhex(digits[at : at + 12].ljust(12, "0"))
            # a key ends where the run does
            if (head[0] != 0x30 or 2 * (_der_size(head) or 0) == len(digits) - at) and is_private_key(bytes.fromhex(digits[at:])):
                found.append(("private_key", m.start() + at, m.end()))
                break
    return found


def scan(text: str | None) -> list[tuple[str, int, int]]:
    """All spans by start, then kind as listed; equal spans of a kind once."""
    text = text or ""
    found = set(base_spans(text)) | set(confirmed_spans(text))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def find(text: Column) -> Column:
    """``array<struct<kind, start, end>>`` of a text, by start, then kind as
    listed in ``KINDS``; positions in code points, end exclusive.  Null and
    empty texts have none; equal texts have equal spans."""

    @F.arrow_udf("array<struct<kind:string,start:int,end:int>>")
    def spans(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        return pa.array([[dict(zip(("kind", "start", "end"), s)) for s in scan(t.as_py())] for t in texts], kind)

    return spans(text)


def scan_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with ``spans`` (one of that name is replaced)."""
    kept = [c for c in docs.columns if c not in (text_col, "spans")]
    return docs.select(*kept, find(F.col(text_col)).alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
