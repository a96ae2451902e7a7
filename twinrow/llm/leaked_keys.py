"""Secrets in texts: base patterns, and structures confirmed by decoding.

Base kinds are ``assign`` (a value of 8 or more characters assigned to a name such
as token), ``access`` (access key ids) and ``hex`` (runs of 32 or more lower-case
hex digits). Beside them, encoded candidates are decoded and reported only if what
they hold parses to its end:

``jwt``  three base64url parts, the first two JSON objects, the first with ``alg``;
``der``  base64 or hex of an ASN.1 sequence whose nested lengths add up and which
         starts like a private key: a version number, then an integer, an octet
         string or an algorithm with an object identifier;
``ssh``  base64 of length-prefixed fields, the first the name of a key type, or of
         the container of private keys that starts with its magic text;
``pem``  a block with BEGIN and END lines around a body that is one of the two, or
         whose headers name a cipher with a start value, and which is whole blocks
         of that cipher. Line breaks may be written as escapes.

A token may follow a point, dash or underscore, and end before a full stop. Runs
of one width on consecutive lines, and a shorter one after them, are also
decoded as one.

Null texts count as empty. Runs of any length are looked at whole; a candidate is
decoded once, so the work is linear in the text.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_right

from pyspark.sql import DataFrame

from twinrow.llm import spans

BASE = ("assign", "access", "hex")
CONFIRMED = ("jwt", "der", "ssh", "pem")

# The base patterns.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
_NAMES = ("passw", "secret", "token", "api")

#: Encoded text shorter than this holds no key.
LEAST = 32
_ENCODED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}+={0,2}" % LEAST)
_BREAK = r"[\x20\t]*+(?:\r?\n|(?:\\+r)?\\+n)[\x20\t]*+"
_WRAPPED = re.compile(
    r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}+(?:%s[A-Za-z0-9+/_-]++={0,2})++" % (LEAST, _BREAK)
)
_LINE = re.compile(r"(?:^|%s)([A-Za-z0-9+/_-]++={0,2})" % _BREAK)
_TOKENS = re.compile(r"[A-Za-z0-9_.-]++")
_HEAD = re.compile(r"(?<![A-Za-z0-9])eyJ")
_ESCAPED = re.compile(r"(?:\\+r)?\\+n")
_HEADER = re.compile(r"\s*([A-Za-z][A-Za-z0-9-]*):(.*)")
_CIPHER = re.compile(r"\s*[A-Z0-9-]+,((?:[0-9A-Fa-f]{2})+)\s*")
_BEGIN = re.compile(r"-----BEGIN ([A-Z0-9 ]*KEY)-----")
_KEY_TYPES = (b"ssh-", b"ecdsa-", b"sk-ssh-", b"sk-ecdsa-")
_MAGIC = b"openssh-key-v1\0"


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans by start, then kind as listed."""
    found = []
    low = text.lower()
    if any(n in low for n in _NAMES):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], BASE.index(s[0])))


def _decoded(text: str) -> bytes | None:
    """Bytes of standard or URL-safe base64 with or without padding."""
    text = text.rstrip("=").translate(str.maketrans("-_", "+/"))
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the content of one ASN.1 element within its parent."""
    if at + 2 > end:
        return None
    tag, size, at = data[at], data[at + 1], at + 2
    if size >= 128:
        n = size - 128
        if not 1 <= n <= 8 or at + n > end:
            return None
        size = int.from_bytes(data[at : at + n], "big")
        at += n
    return (tag, at, at + size) if at + size <= end else None


def _elements(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill a range exactly."""
    found = []
    while at < end:
        one = _element(data, at, end)
        if one is None:
            return None
        found.append(one)
        at = one[2]
    return found


def is_private_der(data: bytes) -> bool:
    """Whether the bytes are one ASN.1 sequence laid out like a private key."""
    outer = _elements(data, 0, len(data))
    if not outer or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    inner = _elements(data, *outer[0][1:])
    if not inner or len(inner) < 3 or inner[0][0] != 0x02 or inner[0][2] - inner[0][1] != 1:
        return False
    tag, at, end = inner[1]
    if tag == 0x02:  # Numbers only: version, modulus, exponents.
        return all(e[0] == 0x02 for e in inner)
    if tag == 0x04:  # A curve key: octets, then tagged parameters.
        return all(e[0] & 0xE0 == 0xA0 for e in inner[2:])
    if tag == 0x30:  # An algorithm, then the wrapped key.
        parts = _elements(data, at, end)
        return bool(parts) and parts[0][0] == 0x06 and inner[2][0] == 0x04
    return False


def is_key_fields(data: bytes) -> bool:
    """Whether the bytes are length-prefixed fields, the first a key type."""
    if data.startswith(_MAGIC):
        at, fields = len(_MAGIC), 3
        for _ in range(fields):
            if at + 4 > len(data):
                return False
            at += 4 + int.from_bytes(data[at : at + 4], "big")
        return at + 4 <= len(data)
    at, first = 0, b""
    count = 0
    while at < len(data):
        if at + 4 > len(data):
            return False
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data):
            return False
        first = first or data[at + 4 : at + 4 + size]
        at += 4 + size
        count += 1
    return count >= 2 and first.startswith(_KEY_TYPES)


def _object(part: str) -> dict | None:
    raw = _decoded(part)
    try:
        value = json.loads(raw) if raw else None
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def _tokens(run: str) -> list[tuple[int, int]]:
    """Signed tokens in a run of base64url characters and points."""
    found = []
    parts = run.split(".")
    at = [0]
    for part in parts:
        at.append(at[-1] + len(part) + 1)
    i = 0
    while i + 2 < len(parts):
        # A fourth part, unless empty, makes it something else.
        if "eyJ" in parts[i] and parts[i + 1] and not (i + 3 < len(parts) and parts[i + 3]):
            if _object(parts[i + 1]) is not None:
                for m in _HEAD.finditer(parts[i]):
                    if "alg" in (_object(parts[i][m.start() :]) or {}):
                        found.append((at[i] + m.start(), at[i + 2] + len(parts[i + 2])))
                        i += 2
                        break
        i += 1
    return found


def _key_kind(run: str) -> str | None:
    """What key the encoded run holds."""
    if len(run) % 2 == 0 and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", run):
        return "der" if is_private_der(bytes.fromhex(run)) else None
    raw = _decoded(run)
    if raw is None:
        return None
    return "der" if is_private_der(raw) else "ssh" if is_key_fields(raw) else None


def _wrapped(text: str) -> list[tuple[str, int, int]]:
    """Keys whose encoded form goes over several lines of one width."""
    found = []
    for m in _WRAPPED.finditer(text):
        lines = [x.span(1) for x in _LINE.finditer(m[0])]
        i = 0
        while i < len(lines):
            width = lines[i][1] - lines[i][0]
            full = i + 1
            while full < len(lines) and lines[full][1] - lines[full][0] == width:
                full += 1
            # The last line is shorter, but a shorter line need not belong to it.
            ends = [full + 1] if full < len(lines) and lines[full][1] - lines[full][0] < width else []
            step = full
            for end in [*ends, full]:
                if end - i < 2 or width < LEAST:
                    continue
                kind = _key_kind("".join(m[0][a:b] for a, b in lines[i:end]))
                if kind:
                    found.append((kind, m.start() + lines[i][0], m.start() + lines[end - 1][1]))
                    step = end
                    break
            i = step
    return found


def _is_pem_body(body: str) -> bool:
    """Whether the text between BEGIN and END holds a key."""
    lines = _ESCAPED.sub("\n", body).split("\n")
    headers = {h[1]: h[2] for line in lines if (h := _HEADER.fullmatch(line))}
    raw = _decoded("".join("".join(x.split()) for x in lines if not _HEADER.fullmatch(x)))
    if not raw:
        return False
    cipher = _CIPHER.fullmatch(headers.get("DEK-Info", ""))
    if cipher and "ENCRYPTED" in headers.get("Proc-Type", ""):
        return len(raw) % (len(cipher[1]) // 2) == 0
    return is_private_der(raw) or is_key_fields(raw)


def _within(blocks: list[tuple[int, int]], place: int) -> bool:
    """Whether a place lies in one of the blocks, which are in order and apart."""
    at = bisect_right(blocks, place, key=lambda b: b[0])
    return at > 0 and place < blocks[at - 1][1]


def confirmed_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans whose decoded content parses, in order of start."""
    found = []
    if "eyJ" in text:
        for m in _TOKENS.finditer(text):
            if "eyJ" in m[0]:
                found += [("jwt", m.start() + a, m.start() + b) for a, b in _tokens(m[0])]
    blocks = []
    begins = list(_BEGIN.finditer(text)) if "-----BEGIN " in text else []
    # A block ends before the next one begins, so no stretch is read twice.
    for m, limit in zip(begins, [*(m.start() for m in begins[1:]), len(text)]):
        close = f"-----END {m[1]}-----"
        end = text.find(close, m.end(), limit)
        if end >= 0 and _is_pem_body(text[m.end() : end]):
            blocks.append((m.start(), end + len(close)))
    found += [("pem", *b) for b in blocks]
    joined = [w for w in _wrapped(text) if not _within(blocks, w[1])]
    found += joined
    blocks = sorted(blocks + [w[1:] for w in joined])
    for m in _ENCODED.finditer(text):
        if _within(blocks, m.start()):
            continue
        kind = _key_kind(m[0])
        if kind:
            found.append((kind, *m.span()))
    return sorted(found, key=lambda s: (s[1], CONFIRMED.index(s[0])))


def _finder():
    return lambda texts: [
        [(*s, True) for s in base_spans(t)] + [(*s, False) for s in confirmed_spans(t)]
        for t in texts
    ]


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and spans of every row: base spans first, then confirmed ones."""
    return spans.scanned(docs, _finder, id_col, text_col)
