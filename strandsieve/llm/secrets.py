"""Secrets: exact base patterns, and encoded credentials that are reported only if their structure holds.

One scan finds the base spans of each text. Beside them it takes every run of base64 (either alphabet, over line breaks
too) or hexadecimal digits that could hold a structure, decodes it and parses what came out:

- key encodings: ASN.1 DER whose nested lengths fit to the byte (PKCS#1, PKCS#8, encrypted PKCS#8, SEC1, DSA, PKCS#12), and
  the OpenSSH form with its length-prefixed strings; bare, or between PEM lines, which may also hold the older encrypted
  form with its cipher and vector in headers. Public keys and certificates are no secrets and are not reported;
- signed tokens: three dotted parts, of which the header names a signature algorithm, the payload is a JSON object, and the
  signature has the length that the algorithm gives.

Decoded bytes that are text again are searched in the same way, so a key that was encoded twice is found. Each level is
shorter than the one around it, so this ends by itself. Nothing is reported for its look alone.

Edge cases: null and empty texts have no spans; rows that repeat a doc_id keep their own results; an empty table gives an
empty result; extra columns are ignored; texts are read whole. A text is taken up again only where a run starts a line, so
the work is in proportion to the text, and to the bytes of the structures that it announces.
"""

from __future__ import annotations

import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandsieve.llm.common import tidy_documents

#: Base kinds as the contract lists them, then those that the method adds.
KINDS = ("assign", "access", "hex", "key", "signed")
_BASE = 3

_ASSIGN = re.compile(r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
# A run is maximal either way: what precedes a match is never one of its characters.
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}+")

_PEM = re.compile(r"-----BEGIN ((?:RSA |EC |DSA |ENCRYPTED |OPENSSH |)PRIVATE KEY)-----")
_BREAK = re.compile(r"(?:\r?\n|\\r\\n|\\n)[ \t]*")
_LINE = r"[A-Za-z0-9+/_-]"
# Runs over line breaks. The least structure, a PKCS#8 key without its curve, takes 40 digits; a token's header takes 15.
_BLOCK = re.compile(rf"(?<!{_LINE}){_LINE}{{15,}}+(?:(?:\r?\n|\\r\\n|\\n)[ \t]*{_LINE}+)*+={{0,2}}")
_ANYHEX = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){15,}+(?![0-9A-Fa-f])")
_SIGNED = re.compile(rf"(?<![A-Za-z0-9_.-])([A-Za-z0-9_-]{{15,}}+)\.([A-Za-z0-9_-]{{3,}}+)\.([A-Za-z0-9_-]*+)(?![A-Za-z0-9_.-]*\.[A-Za-z0-9_-])")
_HEADER = re.compile(r"^[A-Za-z][A-Za-z-]*:[ \t]*(.*)$")
_STANDARD = str.maketrans("-_", "+/")

# Object identifiers of key algorithms and containers, magic and lengths of published formats.
_DATA = bytes.fromhex("2a864886f70d010701")
_ENCRYPTION = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))
_OPENSSH = b"openssh-key-v1\0"
_SIGNATURE_BYTES = {"HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES256K": 64, "ES384": 96, "ES512": 132, "EdDSA": 64}
_RSA_ALGORITHMS = ("RS256", "RS384", "RS512", "PS256", "PS384", "PS512")
_VECTOR_BYTES = {"AES": 16, "DES": 8, "CAM": 16, "ARI": 16, "SEE": 16, "RC2": 8, "BF-": 8, "IDE": 8}


def _tlv(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, and start and end of the content, of the DER element at a place; None if its lengths do not fit."""
    if at + 2 > end:
        return None
    tag, n, at = data[at], data[at + 1], at + 2
    if tag & 0x1F == 0x1F:
        return None
    if n & 0x80:
        more = n & 0x7F
        if not 1 <= more <= 4 or at + more > end or data[at] == 0:
            return None
        n, at = int.from_bytes(data[at : at + more], "big"), at + more
        if n < 0x80:  # the short form is the only one for these
            return None
    return (tag, at, at + n) if at + n <= end else None


def _children(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """All elements between two places, which they must fill to the byte."""
    out = []
    while at < end:
        got = _tlv(data, at, end)
        if got is None:
            return None
        out.append(got)
        at = got[2]
    return out


def _small(data: bytes, element: tuple[int, int, int]) -> int:
    tag, a, z = element
    return data[a] if tag == 2 and z - a == 1 else -1


def _algorithm(data: bytes, element: tuple[int, int, int]) -> bytes | None:
    """The object identifier at the head of an AlgorithmIdentifier."""
    inner = _children(data, element[1], element[2]) if element[0] == 0x30 else None
    return data[inner[0][1] : inner[0][2]] if inner and inner[0][0] == 6 and inner[0][2] > inner[0][1] else None


def der_key(data: bytes) -> str | None:
    """Which private key or key container this DER element is, if all of it is one."""
    outer = _tlv(data, 0, len(data))
    if outer is None or outer[0] != 0x30 or outer[2] != len(data):
        return None
    c = _children(data, outer[1], outer[2])
    if not c or len(c) < 2:
        return None
    tags = [x[0] for x in c]
    version = _small(data, c[0])
    if version in (0, 1) and tags[:3] == [2, 0x30, 4] and c[2][2] > c[2][1] and _algorithm(data, c[1]) and all(t in (0xA0, 0x81, 0xA1) for t in tags[3:]):
        return "pkcs8"
    if version == 0 and tags == [2] * 9 and all(z > a for _, a, z in c):
        return "pkcs1"
    if version == 0 and tags == [2] * 6 and all(z > a for _, a, z in c):
        return "dsa"
    if version == 1 and tags[1] == 4 and c[1][2] - c[1][1] >= 14 and len(c) <= 4 and all(t in (0xA0, 0xA1) for t in tags[2:]) and all(_children(data, a, z) for _, a, z in c[2:]):
        return "sec1"
    if version == 3 and tags[1] == 0x30 and len(c) <= 3 and _algorithm(data, c[1]) == _DATA:
        return "pkcs12"
    if tags == [0x30, 4] and c[1][2] > c[1][1] and (_algorithm(data, c[0]) or b"").startswith(_ENCRYPTION):
        return "encrypted pkcs8"
    return None


def der_length(head: bytes) -> int | None:
    """Bytes of the whole element that starts so, if it is a sequence."""
    if len(head) < 2 or head[0] != 0x30:
        return None
    n = head[1]
    if n < 0x80:
        return 2 + n
    more = n & 0x7F
    return 2 + more + int.from_bytes(head[2 : 2 + more], "big") if 1 <= more <= 4 and len(head) >= 2 + more else None


def openssh_length(data: bytes) -> int | None:
    """Bytes of an OpenSSH private key whose nested lengths hold, else None."""
    if not data.startswith(_OPENSSH):
        return None
    at = len(_OPENSSH)

    def string() -> bytes | None:
        nonlocal at
        n = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + n > len(data) or at + 4 > len(data):
            return None
        out, at = data[at + 4 : at + 4 + n], at + 4 + n
        return out

    cipher, kdf, options = string(), string(), string()
    if cipher is None or kdf is None or options is None or not cipher or not kdf:
        return None
    count, at = int.from_bytes(data[at : at + 4], "big"), at + 4
    if not 1 <= count <= 16 or any(not string() for _ in range(count)):
        return None
    secret = string()
    if not secret or len(secret) % 8:
        return None
    if cipher == b"none" and (len(secret) < 8 or secret[:4] != secret[4:8]):
        return None
    return at


def binary_key(data: bytes) -> str | None:
    return der_key(data) or ("openssh" if openssh_length(data) == len(data) else None)


def _decoded(digits: str) -> bytes | None:
    digits = digits.rstrip("=")
    if len(digits) % 4 == 1:
        return None
    try:
        return binascii.a2b_base64(digits.translate(_STANDARD) + "=" * (-len(digits) % 4))
    except (binascii.Error, ValueError):
        return None


def _even(digits: str) -> str:
    """The digits without a last one that fills no byte."""
    return digits[:-1] if len(digits) % 4 == 1 else digits


def signed_token(header: str, payload: str, signature: str) -> str | None:
    """The algorithm of a signed token, if its header, payload and signature are what they must be."""
    raw = _decoded(header)
    if raw is None or raw.lstrip()[:1] != b"{":
        return None
    try:
        head, body = json.loads(raw), json.loads(_decoded(payload) or b"")
    except (ValueError, RecursionError):
        return None
    name = head.get("alg") if isinstance(head, dict) else None
    if not isinstance(name, str) or not isinstance(body, dict):
        return None
    sign = _decoded(signature)
    if sign is None:
        return None
    holds = len(sign) == _SIGNATURE_BYTES[name] if name in _SIGNATURE_BYTES else len(sign) >= 128 if name in _RSA_ALGORITHMS else name == "none" and not sign
    return name if holds else None


def _inside(data: bytes) -> str | None:
    """What is found in decoded bytes: a key, or text that holds one."""
    found = binary_key(data)
    if found:
        return found
    if len(data) < 15 or any(b > 126 or b < 9 for b in data[:64]) or not data.isascii() or not data.decode().replace("\n", "").replace("\r", "").replace("\t", "").isprintable():
        return None
    inner = structures(data.decode())
    return f"encoded {inner[0][3]}" if inner else None


def _pem(text: str, at: re.Match[str]) -> tuple[int, str] | None:
    """End and form of the armoured key that starts here."""
    label = at[1]
    close = text.find("-----", at.end())  # what closes it is the next such line, so no stretch is read twice
    if close < 0 or not text.startswith(f"-----END {label}-----", close):
        return None
    headers, digits = [], []
    for line in re.split(r"\r?\n|\\r\\n|\\n", text[at.end() : close]):
        line = line.strip()
        header = _HEADER.match(line)
        if header and not digits:
            headers.append(line)
        elif line:
            digits.append("".join(line.split()))
    data = _decoded("".join(digits))
    if not data:
        return None
    end = close + len(label) + 14
    info = next((h.split(":", 1)[1].strip() for h in headers if h.startswith("DEK-Info:")), None)
    if info is not None:
        cipher, _, vector = info.partition(",")
        n = _VECTOR_BYTES.get(cipher[:3].upper())
        return (end, "encrypted pem") if n and re.fullmatch(rf"[0-9A-Fa-f]{{{2 * n}}}", vector) and len(data) % 8 == 0 else None
    found = binary_key(data)
    return (end, found) if found else None


def _base64_keys(text: str, block: re.Match[str]) -> Iterator[tuple[int, int, str]]:
    """Keys that start where a line of the block starts, and end where a line, or its padding, ends."""
    lines, at, stop = [], block.start(), block.end()
    for b in _BREAK.finditer(text, block.start(), block.end()):
        lines.append((at, b.start()))
        at = b.end()
    lines.append((at, stop))
    digits = [text[a:z].rstrip("=") for a, z in lines]
    joined = "".join(digits)
    ends: dict[int, int] = {}  # digits so far: end of the line in the text
    starts, n = [], 0
    for (_, z), d in zip(lines, digits, strict=True):
        starts.append(n)
        n += len(d)
        ends[n] = z
    past = 0
    for (a, _), n in zip(lines, starts, strict=True):
        if n < past:
            continue
        found = None
        head = _decoded(_even(joined[n : n + 20]))
        if head:
            size = der_length(head)
            if size is None and head == _OPENSSH:
                size = openssh_length(_decoded(_even(joined[n:])) or b"")
            if size is not None:
                length = (8 * size + 5) // 6
                if n + length in ends:
                    data = _decoded(joined[n : n + length])
                    what = binary_key(data[:size]) if data else None
                    if what:
                        found, past = (a, ends[n + length], what), n + length
        if found:
            yield found
    if not past:  # no key in binary: perhaps text, as a whole or in one of its lines
        for a, z, part in [(lines[0][0], stop, joined), *((a, z, d) for (a, z), d in zip(lines, digits, strict=True) if len(lines) > 1)]:
            data = _decoded(part) if len(part) >= 20 else None
            what = _inside(data) if data else None
            if what:
                yield a, z, what
                return


def structures(text: str) -> list[tuple[int, int, int, str]]:
    """(start, number of the kind, end, form) of each confirmed structure, in order; none overlaps another."""
    out: list[tuple[int, int, int, str]] = []
    if "-----BEGIN" in text:
        free = 0
        for m in _PEM.finditer(text):
            got = _pem(text, m) if m.start() >= free else None
            if got:
                out.append((m.start(), 3, got[0], got[1]))
                free = got[0]
    if "." in text:
        out += [(m.start(), 4, m.end(), what) for m in _SIGNED.finditer(text) if (what := signed_token(*m.groups()))]
    for m in _BLOCK.finditer(text):
        out += [(a, 3, z, what) for a, z, what in _base64_keys(text, m)]
    for m in _ANYHEX.finditer(text):
        what = _inside(bytes.fromhex(m[0]))
        if what:
            out.append((m.start(), 3, m.end(), what))
    kept, end = [], 0
    for span in sorted(out, key=lambda s: (s[0], -s[2], s[1])):
        if span[0] >= end:
            kept.append(span)
            end = span[2]
    return kept


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of each base span, in order."""
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    return sorted(out + [(m.start(), 2, m.end()) for m in _HEX.finditer(text)])


def shown(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan_text(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, str]]]:
    return base_spans(text), structures(text)


_FOUND = (
    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_found long, "
    "found array<struct<kind:string,start:long,end:long,form:string>>"
)


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex and base_sha256 of base spans; spans: all; n_found and found: those of a confirmed structure, with its form."""
    form = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("form", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts: list[list[int]] = [[] for _ in range(_BASE)]
            sha, spans, found = [], [], []
            for text in b.column(1).to_pylist():
                base, more = scan_text(text)
                for k in range(_BASE):
                    counts[k].append(sum(x[1] == k for x in base))
                sha.append(hashlib.sha256(shown(base).encode()).hexdigest())
                spans.append(shown(sorted(base + [x[:3] for x in more])))
                found.append([{"kind": KINDS[k], "start": s, "end": e, "form": what} for s, k, e, what in more])
            yield pa.record_batch(
                [b.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(sha, pa.string()), pa.array(spans, pa.string()), pa.array([len(f) for f in found], pa.int64()), pa.array(found, pa.list_(form))],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_found", "found"],
            )

    return tidy_documents(docs).mapInArrow(run, _FOUND)


def masked(docs: DataFrame, mark: str = "<secret>") -> DataFrame:
    """The same rows and columns with every span of `text` replaced by `mark`; overlapping spans are one. Null stays null."""

    def run(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts.to_pylist():
            if text is not None:
                base, more = scan_text(text)
                parts, at = [], 0
                for s, _, e in sorted(base + [x[:3] for x in more]):
                    if s >= at:
                        parts += [text[at:s], mark]
                    at = max(at, e)
                text = "".join([*parts, text[at:]])
            out.append(text)
        return pa.array(out, pa.string())

    return docs.withColumn("text", F.arrow_udf(run, "string")("text"))


__all__ = ["KINDS", "base_spans", "binary_key", "der_key", "find_secrets", "masked", "openssh_length", "shown", "signed_token", "structures"]
