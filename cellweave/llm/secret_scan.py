"""Secret scans: Aho-Corasick keyword prefilter, anchored patterns near hits, embedded checksums.

One automaton pass over the text in ASCII lower case finds the keywords of every kind; a kind's
pattern is matched only at its keywords' places, left to right and never inside the match before.
Hexadecimal runs have no keyword: they are found by one pass for runs of the least length.
Kinds added to the base ones carry a checksum inside the token, which has to be right: the last
six characters in base 62 are the CRC-32 of the thirty before them.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .arrow import map_documents

# Kinds in listed order, their patterns, keywords and least lengths.
KINDS = ("assign", "access", "hex", "github", "npm")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
GITHUB = re.compile(r"gh[opsur]_([0-9A-Za-z]{36})(?![0-9A-Za-z])")
NPM = re.compile(r"npm_([0-9A-Za-z]{36})(?![0-9A-Za-z])")
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign", "api_key": "assign",
    "akia": "access", "gho_": "github", "ghp_": "github", "ghs_": "github", "ghu_": "github", "ghr_": "github", "npm_": "npm",
}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

SCHEMA = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "n_assign", "n_access", "n_hex")] + [T.StructField(n, T.StringType()) for n in ("base_sha256", "spans")])


def checksum_holds(token: str) -> bool:
    """Whether the last six of 36 characters are the CRC-32 of the others in base 62."""
    value = 0
    for c in token[30:]:
        value = value * 62 + BASE62.index(c)
    return value == zlib.crc32(token[:30].encode())


ACCEPTS = {
    "assign": (ASSIGN, lambda m: len(m[2]) >= 6),
    "access": (ACCESS, lambda m: len(m[0]) >= 20),
    "github": (GITHUB, lambda m: checksum_holds(m[1])),
    "npm": (NPM, lambda m: checksum_holds(m[1])),
}


@lru_cache(1)
def automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        a.add_word(word, (len(word) - 1, kind))
    a.make_automaton()
    return a


def lowered(text: str) -> str:
    """The text with A-Z in lower case, at the same length; other letters may change with them."""
    low = text.lower()
    return low if len(low) == len(text) else re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def find_secrets(text: str) -> list[tuple[int, int, str]]:
    """Spans (start, end, kind) by start, then kind; code points, end exclusive."""
    found = [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    ended = dict.fromkeys(KINDS, 0)
    hits = sorted((end - back, kind) for end, (back, kind) in automaton().iter(lowered(text)))
    for start, kind in hits:
        if start < ended[kind]:
            continue
        pattern, accepts = ACCEPTS[kind]
        if m := pattern.match(text, start):
            ended[kind] = m.end()
            if accepts(m):
                found.append((start, m.end(), kind))
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Null text counts as empty: no spans, the digest of the empty string. Rows are independent, so
    repeated identifiers give a row each; other columns of docs are not read.
    """

    def columns(ids: list, texts: list) -> list:
        rows = [find_secrets(t) for t in texts]
        said = [[(f"{k}:{s}:{e}", k) for s, e, k in r] for r in rows]
        count = [[sum(k == kind for _, k in r) for r in said] for kind in KINDS[:3]]
        base = [hashlib.sha256(",".join(x for x, k in r if k in KINDS[:3]).encode()).hexdigest() for r in said]
        return [ids, *count, base, [",".join(x for x, _ in r) for r in said]]

    return map_documents(docs, columns, SCHEMA, id_col, text_col)
