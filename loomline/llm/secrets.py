"""Secret scans: patterns, and sliding-window entropy over candidate strings."""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")

#: Window length and bits from which a window counts as random, by character class. A
#: shorter candidate is one window; its threshold is less by the log of the lengths.
WINDOW = 20
THRESHOLDS = {"hex": 3.0, "alnum": 3.6, "letters": 3.7, "base64": 3.9}
#: Capitals, and small letters, that a window of letters alone must hold.
MIXED = 5
#: A name of words that begin with one capital each.
_NAME = "[a-z]+|[A-Z]+|[a-z]*(?:[A-Z][a-z]+)+[A-Z]*"
#: Runs that look random but are not secrets.
ALLOW = re.compile(
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"  # UUID
    r"|[0-9]+"  # plain numbers
    rf"|(?:{_NAME})(?:[-_/](?:{_NAME}))*"  # words, paths and names of words
    r"|[0-9]{4}-[0-9]{2}-[0-9]{2}[0-9TZ_-]*"  # dates
    r"|(?:0123456789abcdef|abcdefghijklmnopqrstuvwxyz|[A-Z]{26}|[0-9+/=])+"  # alphabets
)
#: A span found that meets this word is a sample of documentation.
SAMPLE_WORD = "EXAMPLE"
_LOG = [0.0] + [k * math.log2(k) for k in range(1, WINDOW + 1)]


def char_class(digits: int, uppers: int, lowers: int, beyond_hex: int) -> str | None:
    """The class of a window by what it holds; None for digits, or letters of one case, alone."""
    if not digits:
        return "letters" if uppers >= MIXED and lowers >= MIXED else None
    if not (uppers or lowers):
        return None
    if not beyond_hex:
        return "hex"
    return "base64" if uppers and lowers else "alnum"


def entropy_spans(s: str, window: int = WINDOW, thresholds: dict[str, float] = THRESHOLDS) -> list[tuple[int, int]]:
    """Merged spans of s covered by windows whose entropy reaches their class's threshold.

    Moving the window changes two counts, so the sum of k log2 k is kept up to date.
    """
    scale = 1.0
    if len(s) < window:
        scale = math.log2(max(2, len(s))) / math.log2(window)
        window = len(s)
    counts: dict[str, int] = {}
    total = 0.0
    kinds = [0, 0, 0, 0]  # digits, upper case, lower case, beyond hex
    of = [(c.isdigit(), c.isupper(), c.islower(), c not in "0123456789abcdefABCDEF") for c in s]
    spans: list[tuple[int, int]] = []
    for i, c in enumerate(s):
        if i >= window:
            old = s[i - window]
            k = counts[old]
            total += _LOG[k - 1] - _LOG[k]
            counts[old] = k - 1
            kinds = [a - b for a, b in zip(kinds, of[i - window], strict=True)]
        k = counts.get(c, 0)
        total += _LOG[k + 1] - _LOG[k]
        counts[c] = k + 1
        kinds = [a + b for a, b in zip(kinds, of[i], strict=True)]
        if i >= window - 1:
            name = char_class(*kinds)
            if name and math.log2(window) - total / window >= thresholds[name] * scale - 1e-9:
                a = i - window + 1
                if spans and a <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], i + 1)
                else:
                    spans.append((a, i + 1))
    return spans


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, by start and then kind as listed."""
    out = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return [(a, b, KINDS[k]) for a, k, b in sorted(out)]


def scan(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans, and base with entropy spans. Those inside a base span add nothing and are left out."""
    base = base_spans(text)
    found = list(base)
    starts, ends = [a for a, _, _ in base], list(accumulate((b for _, b, _ in base), max))
    for m in _CANDIDATE.finditer(text):
        if ALLOW.fullmatch(m[0]):
            continue
        for a, b in entropy_spans(m[0]):
            if SAMPLE_WORD in m[0][max(0, a - len(SAMPLE_WORD) + 1) : b + len(SAMPLE_WORD) - 1]:
                continue
            a, b = a + m.start(), b + m.start()
            before = bisect_right(starts, a)
            if not before or ends[before - 1] < b:
                found.append((a, b, "entropy"))
    rank = {k: i for i, k in enumerate((*KINDS, "entropy"))}
    return base, sorted(found, key=lambda x: (x[0], rank[x[2]]))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def _batches(kind: pa.DataType) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            for text in batch.column(1):
                base, found = scan(text.as_py() or "")
                kinds = [k for _, _, k in base]
                for column, x in zip(rows, (*map(kinds.count, KINDS), hashlib.sha256(joined(base).encode()).hexdigest(), joined(found)), strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(kind), *(pa.array(c, pa.int64()) for c in rows[:3]), *(pa.array(c, pa.string()) for c in rows[3:])], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return run


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row per row of docs (doc_id, text): counts and hash of base spans, and all spans.

    Null texts count as empty and, as empty ones, have no spans: zero counts, the hash of
    nothing and "". Ids of any type pass as they are, null or repeated; a text of another
    type is read as its string. Each text is scanned whole, in one task, on its own; an
    empty table gives an empty one; other columns play no part.
    """
    own = docs.schema["doc_id"].dataType
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_batches(to_arrow_type(own)), f"doc_id {own.simpleString()}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(text: str | None, mask: str = "[secret]") -> str | None:
    """text with every span, overlapping ones as one, replaced."""
    if text is None:
        return None
    out, at = [], 0
    for a, b, _ in scan(text)[1]:
        if b > at:
            if a >= at:
                out += [text[at:a], mask]
            at = b
    return "".join([*out, text[at:]])


def op7_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op7_secret_spans": op7_secret_spans}
ORACLE: dict[str, str] = {}
