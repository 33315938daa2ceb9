"""Secret scans that confirm candidates by their structure.

Patterns find assignments, access ids and hex runs; these base spans are
reported as they are. Whatever else could be a secret is decoded first, and
reported only if its inside parses: a signed token needs a JSON header that
names an algorithm and a JSON payload; a key in PEM armour or in bare base64 or
hex needs DER whose nested lengths fill it exactly and which holds integers or
octets as private keys do; an SSH key needs length-prefixed fields that begin
with its type and end where the data ends.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagestrata.llm.words import map_texts

# The base patterns.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")  # runs of 24 and more are the runs that pass
#: Some letters of every assignment; a text without any of them has none.
ASSIGN_HINTS = ("passw", "secret", "token", "apikey", "api_key")
BASE_KINDS = ("assign", "access", "hex")
#: Kinds that the method adds, in the order of spans with the same start.
KINDS = (*BASE_KINDS, "jwt", "pem", "der", "ssh")

# Each starts where its run of characters does and never goes back, so long runs cost no more than others.
JWT = re.compile(r"(?<![A-Za-z0-9_-])e[A-Za-z0-9_-]{7,}+\.[A-Za-z0-9_-]{4,}+\.[A-Za-z0-9_-]*+")  # "{" encodes to "e"
# Line ends may be written as a backslash and a letter; a few lines of headers may come first.
ARMOUR = re.compile(
    r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----(?:\s|\\+[nr])*+((?:[A-Za-z][A-Za-z-]*+:\x20[^\n\\]*+(?:\s|\\+[nr])++){0,8}+)"
    r"((?:[A-Za-z0-9+/=\s]|\\++[nr])++)-----END \1-----"
)
BREAKS = re.compile(r"\s|\\+[nr]")
#: What an encrypted key says in its headers; its body is a whole number of cipher blocks.
ENCRYPTED = re.compile(r"Proc-Type:\x204,ENCRYPTED.*?DEK-Info:\x20[A-Z0-9-]+,[0-9A-Fa-f]{16,}", re.DOTALL)
BASE64 = re.compile(r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{64,}+={0,2}")
RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}+={0,2}")
NEXT_LINE = re.compile(r"(?:\r?\n|\\r\\n|\\n)[\x20\t]*+([A-Za-z0-9+/_-]++={0,2})")
HEX_ANY = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{96,}+")
SSH_TYPES = (b"ssh-rsa", b"ssh-dss", b"ssh-ed25519", b"ecdsa-sha2-nistp256", b"ecdsa-sha2-nistp384", b"ecdsa-sha2-nistp521")
SSH_MAGIC = b"openssh-key-v1\0"


def unbase64(text: str, url: bool = False) -> bytes | None:
    body = text.rstrip("=")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), altchars=b"-_" if url else None, validate=True)
    except (binascii.Error, ValueError):
        return None


def signed_token(candidate: str) -> bool:
    """A header with an algorithm, a payload, and a signature unless the algorithm is none."""
    head, payload, signature = candidate.split(".")
    parsed = []
    for part in (head, payload):
        data = unbase64(part, url=True)
        try:
            parsed.append(json.loads(data) if data else None)
        except (ValueError, RecursionError):
            return False
    if not all(isinstance(x, dict) for x in parsed):
        return False
    algorithm = parsed[0].get("alg")
    if not isinstance(algorithm, str):
        return False
    return algorithm.lower() == "none" or len(unbase64(signature, url=True) or b"") >= 16


def der_items(data: bytes) -> list[tuple[int, int]] | None:
    """``(tag, length)`` of every primitive in DER that fills ``data`` exactly; None if it is not that."""
    out, at, ends = [], 0, [len(data)]
    while True:
        while ends and at == ends[-1]:
            ends.pop()
        if not ends:
            return out
        if at + 2 > ends[-1]:
            return None
        tag, length = data[at], data[at + 1]
        at += 2
        if length & 0x80:
            more = length & 0x7F
            if not 1 <= more <= 4 or at + more > ends[-1]:
                return None
            length = int.from_bytes(data[at : at + more], "big")
            at += more
            if length < 0x80 or length >> 8 * (more - 1) == 0:  # not the shortest form
                return None
        if at + length > ends[-1]:
            return None
        if tag & 0x20:
            ends.append(at + length)
        else:
            out.append((tag, length))
            at += length


def der_key(data: bytes | None) -> bool:
    """One sequence to the end, with integers, octets or bits as long as those of keys."""
    if not data or len(data) < 32 or data[0] != 0x30:
        return False
    items = der_items(data)
    if not items or not any(tag in (0x02, 0x03, 0x04) and n >= 16 for tag, n in items):
        return False
    more = data[1] & 0x7F if data[1] & 0x80 else 0
    length = int.from_bytes(data[2 : 2 + more], "big") if more else data[1]
    return len(data) == 2 + more + length


def ssh_key(data: bytes | None) -> bool:
    """Length-prefixed fields to the end, the first one a key type; or the container of private keys."""
    if not data:
        return False
    if data.startswith(SSH_MAGIC):
        at, names = len(SSH_MAGIC), 0
        while names < 3:  # cipher, key derivation, its options
            if at + 4 > len(data):
                return False
            at += 4 + int.from_bytes(data[at : at + 4], "big")
            names += 1
        return at + 4 <= len(data) and 1 <= int.from_bytes(data[at : at + 4], "big") <= 64
    at, fields = 0, []
    while at < len(data):
        if at + 4 > len(data):
            return False
        n = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + n > len(data):
            return False
        fields.append(data[at + 4 : at + 4 + n])
        at += 4 + n
    return len(fields) >= 2 and fields[0] in SSH_TYPES


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, end, kind)`` of the base patterns' matches that pass."""
    out = []
    low = text.lower()
    if any(h in low for h in ASSIGN_HINTS):
        out += [(*m.span(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(*m.span(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(*m.span(), 2) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], s[2], s[1]))


def decodings(lines: list[str]) -> list[bytes]:
    """What lines, joined, may stand for: hex, base64, base64 for addresses."""
    text, out = "".join(lines), []
    if len(text) >= 96 and len(text) % 2 == 0 and HEX_ANY.fullmatch(text):
        out.append(bytes.fromhex(text))
    if len(text) >= 64:
        out += [unbase64(text, url=u) for u in ((True,) if "-" in text or "_" in text else (False,))]
    return [d for d in out if d]


def key_kind(data: bytes | None) -> int | None:
    return 5 if der_key(data) else 6 if ssh_key(data) else None


def wrapped_keys(text: str) -> list[tuple[int, int, int]]:
    """Keys in base64 or hex over lines of one width, of which the last may be shorter; or on one line."""
    out, done = [], 0
    for m in RUN.finditer(text):
        if m.start() < done:
            continue
        lines, ends, whole = [m[0]], [m.end()], "=" not in m[0]
        while whole:
            more = NEXT_LINE.match(text, ends[-1])
            if not more or len(more[1]) > len(lines[0]):
                break
            lines.append(more[1])
            ends.append(more.end())
            whole = len(more[1]) == len(lines[0]) and "=" not in more[1]
        # The last, shorter line may be the first word of what follows.
        counts = [n for n in (len(lines), len(lines) - 1) if n]
        found = next(((n, k) for n in counts for k in map(key_kind, decodings(lines[:n])) if k), None)
        if found:
            out.append((m.start(), ends[found[0] - 1], found[1]))
        done = ends[found[0] - 1] if found else ends[counts[-1] - 1]
    return out


def confirmed_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, end, kind)`` of the candidates whose structure confirms them.

    Keys in armour may have headers and escaped line ends; bare ones may be
    wrapped over lines of equal width and use either alphabet of base64.
    """
    out = []
    if text.count(".") >= 2:
        out += [(*m.span(), 3) for m in JWT.finditer(text) if signed_token(m[0])]
    taken = []
    if "-----BEGIN" in text:
        for m in ARMOUR.finditer(text):
            data = unbase64(BREAKS.sub("", m[3]))
            if key_kind(data) or data and len(data) >= 32 and len(data) % 8 == 0 and ENCRYPTED.search(m[2]):
                taken.append((*m.span(), 4))
    bare = wrapped_keys(text)
    for pattern in (BASE64, HEX_ANY):
        for m in pattern.finditer(text):
            if pattern is HEX_ANY:
                kind = key_kind(bytes.fromhex(m[0])) if len(m[0]) % 2 == 0 else None
            else:
                kind = key_kind(unbase64(m[0]))
            if kind:
                bare.append((*m.span(), kind))
    # Widest first; what lies inside a key is not another one.
    starts, reach = [], []
    for span in sorted(taken) + sorted(set(bare), key=lambda s: (s[0] - s[1], s)):
        at = bisect.bisect_right(starts, span[0])
        if span[2] == 4 or not at or reach[at - 1] < span[1]:
            starts.insert(at, span[0])
            reach.insert(at, span[1])
            out.append(span)
    return sorted(set(out), key=lambda s: (s[0], s[2], s[1]))


def find_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (the document), ``out.base`` and ``out.added``: spans in code points, end exclusive.

    ``base`` has the patterns' matches, ``added`` what structure confirms; each by
    start, then kind. Null and empty texts have no spans. Every row is scanned
    whole and by itself, so repeated rows agree and an empty table gives no rows.
    """
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])

    def make():
        def of(texts):
            decoded = [t.decode() for t in texts]
            as_rows = lambda found: [{"kind": KINDS[k], "start": a, "stop": b} for a, b, k in found]
            return [pa.array([as_rows(f(t)) for t in decoded], pa.list_(span)) for f in (base_spans, confirmed_spans)]

        return of

    fields = "array<struct<kind:string,start:long,stop:long>>"
    return map_texts(docs, text, make, f"base {fields}, added {fields}")


def joined(spans: F.Column) -> F.Column:
    """``kind:start:end`` of spans, joined by commas, in order of start, then kind."""
    order = F.transform(spans, lambda s: F.struct(s["start"].alias("a"), F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("k"), s["stop"].alias("b"), s["kind"].alias("kind")))
    return F.array_join(F.transform(F.array_sort(order), lambda s: F.concat_ws(":", s["kind"], s["a"], s["b"])), ",")
