"""Secret scan: an Aho-Corasick pass over the text finds keywords, anchored regular expressions
run only where a keyword starts, and formats with an embedded checksum are validated.

Kinds: assign (a keyword with a value of 8 characters or more), access (key ids of 16 characters
or more), hex (runs of 32 hex digits or more; these have no keyword, so runs are found by one
linear expression), then those that this method adds: token (prefixed tokens whose last six
characters are the CRC-32 of the rest in base 62), signed (three-part signed tokens whose
header and payload decode to JSON objects), private (key blocks whose body is base64) and
wallet (base-58 keys whose last four bytes check the double SHA-256).

Defined results: null and empty texts have no spans. Spans count code points, end exclusive.
Rows are scanned each by itself.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from corvid.llm.common import add_columns, fresh, texts_of

#: Keywords of the scan, in lower case, and the kind that each leads to.
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign",
    "api_key": "assign", "akia": "access", "ghp_": "token", "gho_": "token", "ghu_": "token", "ghs_": "token",
    "ghr_": "token", "npm_": "token", "eyj": "signed", "-----begin ": "private", "5h": "wallet", "5j": "wallet",
    "5k": "wallet"}
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "token", "signed", "private", "wallet")

_AT = {
    "assign": re.compile(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A),
    "access": re.compile("AKIA[A-Z0-9]+"),
    "token": re.compile("(?:gh[pousr]|npm)_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
    "signed": re.compile(r"(eyJ[A-Za-z0-9_-]+)\.(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]*"),
    "private": re.compile("-----BEGIN ([A-Z ]*PRIVATE KEY)-----([A-Za-z0-9+/=\\s]+)-----END \\1-----", re.A),
    "wallet": re.compile("5[HJK][1-9A-HJ-NP-Za-km-z]{49}(?![1-9A-HJ-NP-Za-km-z])"),
}
_RUN = re.compile("[A-Za-z0-9_-]+")
_HEX = re.compile("(?<![0-9a-f])[0-9a-f]{32,}")
_DIGITS62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_DIGITS58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"


def crc_base62(body: str) -> str:
    """Six base-62 digits of the CRC-32 of ``body``."""
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, digit = divmod(n, 62)
        out = _DIGITS62[digit] + out
    return out


def _json_part(part: str) -> bool:
    try:
        return isinstance(json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4))), dict)
    except (ValueError, RecursionError):
        return False


def _is_base64(body: str) -> bool:
    try:
        return len(base64.b64decode("".join(body.split()), validate=True)) >= 16
    except binascii.Error:
        return False


def wallet_valid(key: str) -> bool:
    n = 0
    for c in key:
        n = n * 58 + _DIGITS58.index(c)
    if n >= 1 << 304:
        return False
    raw = n.to_bytes(38, "big")[-37:]
    return hashlib.sha256(hashlib.sha256(raw[:-4]).digest()).digest()[:4] == raw[-4:]


_VALID = {
    "assign": lambda m: len(m[1]) >= 8,
    "access": lambda m: len(m[0]) >= 16,
    "token": lambda m: crc_base62(m[0][4:-6]) == m[0][-6:],
    "signed": lambda m: _json_part(m[1]) and _json_part(m[2]),
    "private": lambda m: _is_base64(m[2]),
    "wallet": lambda m: wallet_valid(m[0]),
}


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def scan(text: str, keywords: ahocorasick.Automaton) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all secrets, by start, then kind in the order of KINDS."""
    spans = []
    lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # A-Z alone: places stay
    starts: dict[str, list[int]] = {}
    for end, (kind, length) in keywords.iter(lowered):
        starts.setdefault(kind, []).append(end - length + 1)
    for kind, places in starts.items():
        beyond = 0
        for start in sorted(places):
            if start < beyond:
                continue
            # leftmost, non-overlapping: a match that fails validation still takes its text
            if m := _AT[kind].match(text, start):
                beyond = m.end()
                if _VALID[kind](m):
                    spans.append((start, beyond, kind))
            elif kind == "signed":
                # a part ends where its run ends, so what failed here fails from all places in the run
                beyond = _RUN.match(text, start).end()
    spans += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def find_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_assign``, ``n_access``, ``n_hex``, ``base_spans`` and ``spans``
    (kind:start:end by start, joined by commas)."""
    at = docs.columns.index(text_col)

    def found(batch):
        keywords = automaton()
        all_spans = [scan(t, keywords) for t in texts_of(batch.column(at))]
        counts = [pa.array([sum(s[2] == kind for s in spans) for spans in all_spans], pa.int64()) for kind in BASE]
        return counts + [pa.array([joined(s for s in spans if s[2] in BASE) for spans in all_spans], pa.string()),
                         pa.array([joined(spans) for spans in all_spans], pa.string())]

    fields = [T.StructField(fresh(docs, f"n_{kind}"), T.LongType()) for kind in BASE]
    return add_columns(docs, found, fields + [T.StructField(fresh(docs, "base_spans"), T.StringType()),
                                              T.StructField(fresh(docs, "spans"), T.StringType())])
