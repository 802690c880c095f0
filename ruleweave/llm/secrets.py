"""Secret scan: keyword automaton, anchored expressions near its hits, embedded checksums.

One Aho-Corasick pass over the ASCII-lowered UTF-8 bytes finds keywords; runs of
hexadecimal digits are found by the same means on the bytes mapped to
character classes, where the keyword is 24 times the class "hex digit".  Only
at a hit is an expression tried, anchored there.  Kinds whose tokens carry a
checksum are accepted only if it agrees.

Kinds, in the order that sorts spans of equal start:

- ``assign``, ``access``, ``hex``: assignments, access key ids, long hex runs;
- ``github`` (``gh?_`` tokens) and ``npm``: last six characters are the base-62
  CRC-32 of the thirty before;
- ``xprv``: serialised extended private keys, base 58 with a four-byte double
  SHA-256 checksum.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ruleweave.llm.common import map_slices, share_code

KINDS = ("assign", "access", "hex", "github", "npm", "xprv")
BASE = KINDS[:3]
HEX_RUN = 24

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
GITHUB = re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
NPM = re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
XPRV = re.compile(r"xprv[1-9A-HJ-NP-Za-km-z]{107}(?![1-9A-HJ-NP-Za-km-z])")

# Keywords of each kind, lower case.
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
    "xprv": ("xprv",),
}
# Digits of base 62 and base 58.
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"

_CLASSES = bytes(ord("h") if chr(b) in "0123456789abcdef" else ord(".") for b in range(256))


def crc_base62(body: str) -> str:
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        out = BASE62[d] + out
    return out


def base58check(s: str) -> bool:
    n = 0
    for c in s:
        n = n * 58 + BASE58.index(c)
    raw = n.to_bytes((n.bit_length() + 7) // 8, "big")
    raw = b"\0" * (len(s) - len(s.lstrip("1"))) + raw
    return len(raw) > 4 and hashlib.sha256(hashlib.sha256(raw[:-4]).digest()).digest()[:4] == raw[-4:]


class Scanner:
    def __init__(self):
        import ahocorasick

        self.words = ahocorasick.Automaton()
        for kind, keys in KEYWORDS.items():
            for k in keys:
                self.words.add_word(k, (kind, len(k)))
        self.words.make_automaton()

    def hits(self, text: str) -> list[tuple[int, str]]:
        """(code point, kind) of every keyword hit, in order."""
        data = text.encode()
        found = [(end + 1 - n, kind) for end, (kind, n) in self.words.iter(data.lower().decode("latin-1"))]
        classes, key, at = data.translate(_CLASSES), b"h" * HEX_RUN, 0
        while (at := classes.find(key, at)) >= 0:
            found.append((at, "hex"))
            end = classes.find(b".", at)
            at = len(classes) if end < 0 else end
        found.sort()
        if len(data) == len(text):
            return found
        out, seen, points = [], 0, 0
        for at, kind in found:  # byte offsets to code points, one pass
            points += len(data[seen:at].decode())
            seen = at
            out.append((points, kind))
        return out

    def scan(self, text: str) -> list[tuple[int, int, str]]:
        """(start, end, kind) of every secret, by start, then kind."""
        out, free = [], dict.fromkeys(KINDS, 0)
        for at, kind in self.hits(text):
            if at < free[kind]:
                continue
            if kind == "assign":
                m = ASSIGN.match(text, at)
                ok = m and len(m[2]) >= 6
            elif kind == "access":
                m = ACCESS.match(text, at)
                ok = m and len(m[0]) >= 20
            elif kind == "hex":
                m = HEX.match(text, at)
                ok = m
            elif kind == "xprv":
                m = XPRV.match(text, at)
                ok = m and base58check(m[0])
            else:
                m = (GITHUB if kind == "github" else NPM).match(text, at)
                ok = m and crc_base62(m[1]) == m[2]
            if m:
                free[kind] = m.end()
            if ok:
                out.append((at, m.end(), kind))
        out.sort(key=lambda s: (s[0], KINDS.index(s[2])))
        return out


def redact(text: str, spans: list[tuple[int, int, str]], mask: str) -> str:
    """``text`` with every stretch covered by spans replaced by ``mask``."""
    out, at = [], 0
    for start, end, _ in spans:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


_SCANNER: list[Scanner] = []


def _scanner() -> Scanner:
    if not _SCANNER:
        _SCANNER.append(Scanner())
    return _SCANNER[0]


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id, spans array<struct<start, end, kind>>>`` for every row (start and end in code points, end exclusive).

    Null and empty texts have no span; whole texts are scanned; repeated rows
    and null ids are scanned like any other; other columns are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def make():
        scan = _scanner().scan

        def fn(ids, texts):
            return [ids, [[dict(zip(("start", "end", "kind"), s)) for s in scan(t or "")] for t in texts]]

        return fn

    return map_slices(docs.select(F.col(id_col), F.col(text_col)), make,
                      f"`{id_col}` {id_type}, spans array<struct<start: bigint, `end`: bigint, kind: string>>")


def redact_secrets(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret in the text replaced by ``mask``.

    Texts without secrets stay as they are, null and empty ones too.  Whole texts are scanned, of overlapping secrets
    the union is masked once.  Rows, their number and all other columns are kept, whatever their names; an empty table stays empty.
    """
    share_code(docs.sparkSession)

    @pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        scan = _scanner().scan
        return texts.map(lambda t: t if not t or not (s := scan(t)) else redact(t, s, mask))

    return docs.withColumn(text_col, clean(F.col(text_col)))


def secret_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts per base kind, the checksum of the base spans and all spans as text."""
    of = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long")
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    base = F.filter("spans", lambda s: s.kind.isin(*BASE))
    return found.select(F.col(id_col), *[of(k).alias(f"n_{k}") for k in BASE],
                        F.sha2(line(base).cast("binary"), 256).alias("base_sha256"),
                        line(F.col("spans")).alias("spans"))
