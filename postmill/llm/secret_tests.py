"""Secrets in texts: fixed patterns, and a battery of randomness tests on token strings.

Base spans come from three patterns and always stay. Beyond them, runs of at least
SHORTEST letters, digits and "+/_=-" that mix kinds of characters are candidates. Each is
read in the encoding that its characters fit (hex, base32, base64) and tested three ways:

- chi-squared: do the characters use the alphabet evenly,
- runs: do they cross the middle of the alphabet as often as chance would,
- serial correlation: does a character say anything about the next.

The tests ask how far a string is from what written words would give, at its own length:
each statistic has a normal law for words, with a mean and spread that grow with the
length, and the three one-sided p-values are combined by Stouffer's sum. Short strings
can hardly reach a small p. The candidates of a document are then held to one false
discovery rate by the Benjamini-Hochberg rule, and what passes is added as `random`,
unless a base span overlaps it.

Documents are read where they are; nothing is shuffled.

Defined cases: null text is empty, and has no spans and the digest of an empty string.
Repeated documents are reported each. Other columns are ignored. Offsets are code points,
end exclusive; a base span is the whole match of its pattern.
"""

from __future__ import annotations

import hashlib
import math
import re
from statistics import NormalDist

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.arrays import pieces

# Patterns and lengths fixed by the contract of the query, in listed order.
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
KINDS = ("assign", "access", "hex", "random")
LEAST = {"assign": 6, "access": 20, "hex": 24}

SHORTEST = 20
FALSE_DISCOVERIES = 0.01
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
LONG_HEX = re.compile(r"[0-9a-f]{24,}")
ENCODINGS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
# Words use an alphabet of k unevenly: the sum over characters of (p - 1/k)^2 k, for
# letter frequencies of written language. In hex only a few letters can occur.
UNEVEN = {"hex": 1.2, "base32": 1.0, "base64": 3.0}
NORMAL = NormalDist()

RESULT = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long"


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, leftmost and not overlapping within a kind."""
    spans = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    # Greedy runs of 24 and more are the runs that the shorter pattern's length rule keeps.
    spans += [("hex", m.start(), m.end()) for m in LONG_HEX.finditer(text)]
    return spans


def encoding_of(token: str) -> str | None:
    """The smallest encoding that fits a token that mixes kinds of characters, else None."""
    digit = any(c.isdigit() for c in token)
    lower, upper = any(c.islower() for c in token), any(c.isupper() for c in token)
    if digit and not (lower and upper) and set(token.lower()) <= set(ENCODINGS["hex"]):
        return "hex"
    if digit and set(token) <= set(ENCODINGS["base32"]):
        return "base32"
    return "base64" if digit + lower + upper >= 2 and (digit or not token.istitle()) else None


def word_p_value(token: str, encoding: str) -> float:
    """How likely written words of this length are to look as random as the token does."""
    alphabet = ENCODINGS[encoding]
    token = token.rstrip("=").replace("-", "+").replace("_", "/").replace("=", "")
    if encoding == "hex":
        token = token.lower()
    place = [alphabet.index(c) for c in token if c in alphabet]
    n, k = len(place), len(alphabet)
    if n < SHORTEST:
        return 1.0
    counts = [0] * k
    for p in place:
        counts[p] += 1
    chi = sum(c * c for c in counts) * k / n - n
    shift = n * UNEVEN[encoding]
    even = (chi - (k - 1 + shift)) / math.sqrt(2 * (k - 1 + 2 * shift))
    high = [p >= k / 2 for p in place]
    ones = sum(high)
    runs = 1 + sum(a != b for a, b in zip(high, high[1:], strict=False))
    # Words stay in one part of the alphabet: half of the crossings chance would give.
    chance = 2 * ones * (n - ones) / n + 1
    spread = math.sqrt(max(n - 1, 1)) / 2
    crossing = (chance / 2 - min(runs, chance)) / spread if ones not in (0, n) else n / (2 * spread)
    mean = sum(place) / n
    around = sum((p - mean) ** 2 for p in place)
    serial = sum((a - mean) * (b - mean) for a, b in zip(place, place[1:], strict=False)) / around if around else 1.0
    # Neighbouring letters of words correlate; chance gives 0 with deviation 1 / sqrt(n).
    follow = (abs(serial) - 0.25) * math.sqrt(n)
    return NORMAL.cdf((2 * even + crossing + follow) / math.sqrt(6))


def random_spans(text: str, base: list[tuple[str, int, int]], rate: float = FALSE_DISCOVERIES) -> list[tuple[str, int, int]]:
    """Candidates that pass the tests, at this false discovery rate within the text."""
    found = []
    for m in CANDIDATE.finditer(text):
        token = m[0]
        if (encoding := None if token.isalpha() and (token.islower() or token.istitle() or token.isupper()) else encoding_of(token)) is None:
            continue
        found.append((word_p_value(token, encoding), m.start(), m.end()))
    if not found:
        return []
    found.sort()
    passed = max((i for i, (p, _, _) in enumerate(found, 1) if p <= rate * i / len(found)), default=0)
    return [("random", a, b) for _, a, b in found[:passed] if not any(a < e and s < b for _, s, e in base)]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2])))


def secrets(docs: DataFrame) -> DataFrame:
    """Per document: counts by kind, digest of the base spans, and all spans."""

    def scan(batches):
        for batch in pieces(batches, "text"):
            rows = []
            for text in batch.column("text").to_pylist():
                base = base_spans(text)
                more = random_spans(text, base)
                number = [sum(k == kind for k, _, _ in base) for kind in KINDS[:3]]
                rows.append((*number, hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + more), len(more)))
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"]
            yield pa.record_batch([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(scan, RESULT)
