"""Secret scans with structural confirmation.

Three base patterns find assignments, access ids and long hex runs. The method then looks at
every base64, base64url and hex candidate, decodes it, and reports it only where the decoded
bytes prove what they are: nested DER lengths that add up for a key, an OpenSSH key container,
a PEM block whose body decodes to either (a private key may be locked or PGP armour: header lines
and a closing checksum line are no part of the body), or a signed token whose header is a JSON
object that names its algorithm. Keys are also found as the last segment of a path, wrapped over
lines without a frame, as base64 of a whole PEM block, and as hex pairs with colons between them.

Kinds, in the order used for ties: assign, access, hex, der, openssh, pem, token. Offsets are
code points, ends are exclusive.

Defined results: null and empty texts have no spans; every row is judged by itself.

Columns: an input column named like the result is replaced; names that begin with two underscores are the
operator's own and may be replaced or dropped; all others come back unchanged.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.llm import words as W

KINDS = ("assign", "access", "hex", "der", "openssh", "pem", "token")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
HINT = re.compile(rb"passw|secret|token|api_?key", re.IGNORECASE)
ENCODED = re.compile(r"[A-Za-z0-9+/_-]{32,}={0,2}")
HEX_ANY = re.compile(r"(?:[0-9a-f]{2}){16,}|(?:[0-9A-F]{2}){16,}")
_EOL = r"(?:\r?\n|(?:\\r)?\\n)"  # as it is, or escaped as in JSON
_REST = rf"(?:(?!{_EOL}|-----(?:BEGIN|END) )[^\n])*{_EOL}"
_HEADER = rf"[A-Za-z][A-Za-z0-9-]*:{_REST}(?:[ \t]+(?!{_EOL})(?=\S){_REST})*"
#: Label, header lines (RFC 1421, PGP armour) that a blank line ends, body.
PEM = re.compile(rf"-----BEGIN ([A-Z0-9 ]{{1,40}})-----(?:[ \t]*{_EOL}(?:{_HEADER})+[ \t]*{_EOL})?([A-Za-z0-9+/=\s\\]{{16,}}?)-----END \1-----", re.ASCII)
PEM_CRC = re.compile(r"(?:\s|\\n)=[A-Za-z0-9+/]{4}(?:\s|\\[rn])*\Z", re.ASCII)
#: Base64 over several lines, from the beginning of a run on.
WRAPPED = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{20,}}+(?:{_EOL}[ \t]*[A-Za-z0-9+/_-]++={{0,2}})+", re.ASCII)
COLON_HEX = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{2}:\s*){15,}+[0-9A-Fa-f]{2}(?![0-9A-Fa-f])", re.ASCII)
#: Where in a path a key can begin: by the first letters of its base64.
KEY_START = re.compile(r"(?<=/)(?=M|AAAA|b3BlbnNzaC1rZXkt)")
TOKEN = re.compile(r"(?<![A-Za-z0-9_.-])([A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)")

_ENCODED = np.zeros(256, bool)
_ENCODED[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-.=:")] = True

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """assign, access and hex; leftmost, not overlapping within a kind."""
    out = []
    for m in ASSIGN.finditer(text):
        if len(m[2]) >= 8:
            out.append((m.start(), m.end(), "assign"))
    for m in ACCESS.finditer(text):
        if m.end() - m.start() >= 16:
            out.append((m.start(), m.end(), "access"))
    for m in HEX.finditer(text):
        out.append((m.start(), m.end(), "hex"))
    return out


def unbase64(text: str) -> bytes | None:
    """The bytes of base64 or base64url text, or None."""
    body = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_values(data: bytes) -> list[tuple[int, bytes]] | None:
    """The (tag, content) values that fill data exactly, or None where a length does not fit."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            more = size & 0x7F
            if not 1 <= more <= 4 or at + more > len(data):
                return None
            size = int.from_bytes(data[at : at + more], "big")
            at += more
        if at + size > len(data):
            return None
        out.append((tag, data[at : at + size]))
        at += size
    return out


def is_der_key(data: bytes) -> bool:
    """One sequence whose nested lengths add up and that holds numbers, an algorithm or key bytes."""
    if len(data) < 24 or data[0] != 0x30:
        return False
    outer = der_values(data)
    inner = der_values(outer[0][1]) if outer and len(outer) == 1 else None
    if not inner:
        return False
    tags = [tag for tag, _ in inner]
    if 0x30 in tags and not all(der_values(x) is not None for tag, x in inner if tag == 0x30):
        return False
    numbers = tags[0] == 0x02 and (len(tags) >= 9 and set(tags) == {0x02} or 0x04 in tags)
    public = tags == [0x30, 0x03]
    locked = tags == [0x30, 0x04]
    return numbers or public or locked


def is_openssh_key(data: bytes) -> bool:
    """The private key container, or a public key whose two first length-prefixed strings fit."""
    if data.startswith(b"openssh-key-v1\0"):
        return True
    if len(data) < 20:
        return False
    size = int.from_bytes(data[:4], "big")
    name = data[4 : 4 + size]
    if not 7 <= size <= 40 or not re.fullmatch(rb"(ssh|ecdsa|sk)-[a-z0-9@.-]+", name):
        return False
    after = 4 + size
    return after + 4 + int.from_bytes(data[after : after + 4], "big") <= len(data)


def key_kind(data: bytes | None) -> str | None:
    if data is None:
        return None
    if data.lstrip()[:11] == b"-----BEGIN ":
        return "pem" if any(is_pem_key(m) for m in PEM.finditer(data.decode("latin-1"))) else None
    return "der" if is_der_key(data) else "openssh" if is_openssh_key(data) else None


def is_pem_key(m: re.Match) -> bool:
    """Whether the body of a PEM block is a key, or decodes at all where the label says private key."""
    data = unbase64(re.sub(r"\\[rn]|\s", "", PEM_CRC.sub("", m[2])))
    return bool(data and (is_der_key(data) or is_openssh_key(data) or "PRIVATE KEY" in m[1]))


def der_size(head: str) -> int | None:
    """Bytes of the sequence that begins with these eight base64 letters."""
    data = unbase64(head[:8])
    if not data or len(data) < 6 or data[0] != 0x30:
        return None
    more = data[1] & 0x7F
    if not data[1] & 0x80:
        return 2 + more
    return 2 + more + int.from_bytes(data[2 : 2 + more], "big") if 1 <= more <= 4 else None


def path_keys(text: str) -> list[tuple[int, str]]:
    """(start, kind) of a key after some slash of a candidate that goes on to its end.

    Only the first letters are decoded at most slashes: they tell the length of a key.
    """
    out = []
    n = len(text.rstrip("=")) * 3
    for m in KEY_START.finditer(text):
        at = m.start()
        if text[at] == "M":
            fits = der_size(text[at : at + 8]) == (n - 3 * at) // 4
        elif text[at] == "A":
            head = unbase64(text[at : at + 12]) or b""
            fits = head[4:6] in (b"ss", b"ec", b"sk")
        else:
            fits = True
        if fits and (kind := key_kind(unbase64(text[at:]))):
            out.append((at, kind))
    return out


def wrapped_key(m: re.Match) -> tuple[int, str] | None:
    """(end, kind) of a key that begins where the lines do and may end before they do."""
    lines = re.sub(r"\\[rn]|\s", "", m[0])
    size = der_size(lines)
    if size is None:
        kind = key_kind(unbase64(lines))
        return (m.end(), kind) if kind else None
    letters = -(-size * 4 // 3)
    kind = key_kind(unbase64(lines[:letters])) if letters <= len(lines) else None
    if not kind:
        return None
    seen, end = 0, m.start()
    for part in re.finditer(r"\\[rn]|\s|[^\s\\]", m[0]):
        if len(part[0]) == 1 and not part[0].isspace():
            seen += 1
            if seen > letters and part[0] != "=":
                break
            end = m.start() + part.end()
    return end, kind


def is_token_header(text: str) -> bool:
    data = unbase64(text)
    if not data or data[:1] != b"{":
        return False
    try:
        header = json.loads(data)
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str)


def method_spans(text: str) -> list[Span]:
    """What structure confirms: der, openssh, pem and token."""
    out = []
    for m in PEM.finditer(text):
        if is_pem_key(m):
            out.append((m.start(), m.end(), "pem"))
    for m in TOKEN.finditer(text):
        if is_token_header(m[1]):
            out.append((m.start(), m.end(), "token"))
    for m in ENCODED.finditer(text):
        if kind := key_kind(unbase64(m[0])):
            out.append((m.start(), m.end(), kind))
        else:
            out += [(m.start() + at, m.end(), kind) for at, kind in path_keys(m[0])]
    for m in WRAPPED.finditer(text):
        if found := wrapped_key(m):
            out.append((m.start(), *found))
    for m in COLON_HEX.finditer(text):
        if kind := key_kind(bytes.fromhex(re.sub(r"[:\s]", "", m[0]))):
            out.append((m.start(), m.end(), kind))
    for m in HEX_ANY.finditer(text):
        if kind := key_kind(bytes.fromhex(m[0])):
            out.append((m.start(), m.end(), kind))
    return out


def joined(spans: list[Span]) -> str:
    """kind:start:end by start, then by kind as listed."""
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in sorted(set(spans), key=lambda x: (x[0], KINDS.index(x[2]), x[1])))


def candidates(texts: pa.Array) -> np.ndarray:
    """Which texts can hold any span: each needs a hint word or 16 characters of an encoding in a row."""
    words = W.split(texts, _ENCODED)
    long = W.per_doc(words.end - words.begin >= 16, words.first) > 0
    raw, offsets = words.data.tobytes(), W.text_bytes(texts)[1]
    for d in np.flatnonzero(~long):
        long[d] = HINT.search(raw, offsets[d], offsets[d + 1]) is not None
    return long


def find_spans(texts: pa.Array) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, method spans) of each text."""
    out: list[tuple[list[Span], list[Span]]] = []
    for _, part in W.slices(texts):
        found: list[tuple[list[Span], list[Span]]] = [([], [])] * len(part)
        for d in np.flatnonzero(candidates(part)):
            text = part[int(d)].as_py() or ""
            found[d] = (base_spans(text), method_spans(text))
        out += found
    return out


def find_secrets(docs: DataFrame, text: str = "text", out: str = "secrets") -> DataFrame:
    """Append a struct column `out`: spans found by each base pattern, base and all spans as text."""

    @F.arrow_udf("struct<n_assign:bigint,n_access:bigint,n_hex:bigint,base:string,spans:string>")
    def scan(texts: pa.Array) -> pa.Array:
        found = find_spans(texts)
        counts = [pa.array([sum(s[2] == kind for s in base) for base, _ in found], pa.int64()) for kind in KINDS[:3]]
        shown = [pa.array([joined(base) for base, _ in found], pa.string()), pa.array([joined(base + more) for base, more in found], pa.string())]
        return pa.StructArray.from_arrays(counts + shown, names=["n_assign", "n_access", "n_hex", "base", "spans"])

    return docs.withColumn(out, scan(F.col(text)))


def redact(text: str, spans: list[Span], mark: str) -> str:
    out, at = [], 0
    for a, b, _ in sorted(spans):
        if b > at:
            out.append(text[at : max(a, at)] + (mark if a >= at else ""))
            at = b
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """All documents, each span replaced by mark (overlapping spans by one); other columns as they are."""

    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        own = texts.to_pylist()
        for d, (base, more) in enumerate(find_spans(texts)):
            if base or more:
                own[d] = redact(own[d], base + more, mark)
        return pa.array(own, pa.string())

    return docs.withColumn(text, clean(F.col(text)))
