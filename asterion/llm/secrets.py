"""Secrets by token efficiency.

Ordinary words and identifiers take few tokens of a byte-pair vocabulary; random
strings take many. Candidates are unbroken runs of 20 or more key characters; one
of fewer than ``ratio`` characters a token is reported as kind ``random``. Digests in
lower case, which are ``hex`` spans, UUIDs and identifiers are taken out. An identifier
is made of words joined by case, digits or signs whose letters (digits, if it has none)
reach the ratio, or which is a base span from end to end already. Of a run that is not reported, the parts of 20 or more characters
between ``/`` and ``=``, and then between any signs, are judged likewise. Base spans
(assign, access, hex) always stay.

Null and empty texts have no spans; rows are judged one by one, so repeated rows
repeat; extra columns are ignored; texts are read whole.
"""

from __future__ import annotations

import base64
import functools
import re
from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, texts

KINDS = ["assign", "access", "hex", "random"]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
DIGEST = re.compile(r"[0-9a-f]+")
DIGEST_LENGTHS = {32, 40, 56, 64, 96, 128}
IDENTIFIER = re.compile(r"([A-Z]?[a-z]+|[A-Z]+|[0-9]+)([_/=+-]+([A-Z]?[a-z]+|[A-Z]+|[0-9]+))*|[A-Z]?[a-z]{3,}([A-Z][a-z]{3,})*[0-9]*")
LETTERS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
DIGITS = re.compile(r"[0-9]+")
#: A run, its parts between / and =, and its parts between all signs.
PARTS = (RUN, re.compile(r"[A-Za-z0-9+_-]{20,}"), re.compile(r"[A-Za-z0-9]{20,}"))


@functools.lru_cache(maxsize=2)
def encoding(path: str, pattern: str):
    import tiktoken
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("secrets", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the three base kinds."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(fold(text)) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    return out + [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 32]


def is_named(s: str, enc, ratio: float, known: bool) -> bool:
    """Whether a run is a UUID, a digest of the hex kind, or an identifier that is known or made of ordinary words."""
    if UUID.fullmatch(s) or (len(s) in DIGEST_LENGTHS and DIGEST.fullmatch(s)):
        return True
    if not IDENTIFIER.fullmatch(s):
        return False
    words = LETTERS.findall(s) or DIGITS.findall(s)
    return known or sum(map(len, words)) >= ratio * sum(len(enc.encode_ordinary(w)) for w in words)


def random_spans(text: str, enc, ratio: float, base: set[tuple[int, int]] = frozenset(), start: int = 0, end: int | None = None, depth: int = 0) -> list[tuple[int, int, int]]:
    found = []
    for m in PARTS[depth].finditer(text, start, len(text) if end is None else end):
        s = m[0]
        if len(s) < ratio * len(enc.encode_ordinary(s)) and not is_named(s, enc, ratio, m.span() in base):
            found.append((m.start(), 3, m.end()))
        elif depth + 1 < len(PARTS) and not UUID.fullmatch(s):
            found += random_spans(text, enc, ratio, base, m.start(), m.end(), depth + 1)
    return found


def find(docs: DataFrame, ranks_path: str, pattern: str, *, ratio: float = 2.2) -> DataFrame:
    """Per row: doc_id and ``found``, an array of (kind, start, end, base, value) by start, then kind."""
    def run(batches):
        enc = encoding(ranks_path, pattern)
        for b in batches:
            out = []
            for t in texts(b["text"]):
                base = base_spans(t)
                spans = sorted(base + random_spans(t, enc, ratio, {(a, e) for a, _, e in base}))
                out.append([(KINDS[k], s, e, k < 3, t[s:e]) for s, k, e in spans])
            yield pd.DataFrame({"doc_id": b["doc_id"], "found": out})
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInPandas(
        run, "doc_id bigint, found array<struct<kind:string,start:bigint,end:bigint,base:boolean,value:string>>")


def is_kind(kind: str, x: Column) -> Column:
    return x["kind"] == kind


def report(found: DataFrame) -> DataFrame:
    joined = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    counts = [F.size(F.filter("found", partial(is_kind, k))).cast("bigint").alias(f"n_{k}") for k in KINDS[:3]]
    return found.select("doc_id", *counts, F.sha2(joined(F.filter("found", lambda x: x["base"])), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))


__all__ = ["find", "report", "base_spans"]
