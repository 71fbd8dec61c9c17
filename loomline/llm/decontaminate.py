"""Benchmark decontamination by winnowing.

Of every window of consecutive k-gram hashes the smallest is a fingerprint. Two texts that
share a span of window + k - 1 words share the fingerprint of each window inside it, so
joining the fingerprints of documents and of benchmark items misses no such span. A hit is
then extended along its diagonal to all runs of equal words; runs of at least that many
words count. Items that are shorter than one span are looked up whole, by length.

A benchmark of bounded size is sent to all tasks once, as a sorted table of fingerprints. The
fingerprints of a larger one are joined by shuffle, on their hashes, and texts move only for
the pairs of a document and an item that share one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.llm.shared import packed, written
from loomline.llm.words import ALNUM, Words, shingle_hashes, word_slices

K = 5
#: Bytes of benchmark text that are sent to all tasks; more is joined by shuffle.
BLOCK_BYTES = 16 << 20
#: Bits of an item hash that the filter of the shuffled join tells apart, and places in which a hash of documents is met.
FILTER_BITS = 24
SALTS = 16
RESULT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def fingerprints(w: Words, span: int, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """(hash, word index) of the winnowed k-grams of all rows of at least `span` words.

    Of equal smallest hashes the rightmost counts, in every text alike.
    """
    n = len(w.hash)
    window = span - k + 1
    starts = n - span + 1
    if starts <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    acc = np.zeros(n - k + 1, dtype=np.uint64)
    for j in range(k):
        acc = acc * np.uint64(0xD1342543DE82EF95) + w.hash[j : j + len(acc)]
    best = np.arange(starts)
    low = acc[:starts].copy()
    for j in range(1, window):
        other = acc[j : j + starts]
        better = other <= low
        best[better] = np.flatnonzero(better) + j
        low[better] = other[better]
    picked = np.unique(best[w.row[:starts] == w.row[span - 1 :]])
    return acc[picked], picked


@dataclass
class Block:
    """Items of a benchmark as word hashes, fingerprints sorted for the join."""

    span: int
    names: list[str]
    words: list[np.ndarray] = field(default_factory=list)
    prints: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    places: np.ndarray = field(default_factory=lambda: np.empty((0, 2), np.int64))  # item, word index
    short: dict[int, dict[int, list[str]]] = field(default_factory=dict)  # by length: hash -> names


def block_of(rows: list[tuple[object, str | None]], span: int, k: int = K) -> Block:
    block = Block(span, [])
    prints, places = [], []
    for w in word_slices(pa.array([t for _, t in rows], pa.string()), ALNUM):
        hashes, at = fingerprints(w, span, k)
        base = len(block.names)
        for r in range(w.rows):
            block.names.append(str(rows[w.first + r][0]))
            block.words.append(w.hash[w.bound[r] : w.bound[r + 1]])
        prints.append(hashes)
        places.append(np.stack((w.row[at] + base, at - w.bound[w.row[at]]), axis=1) if len(at) else np.empty((0, 2), np.int64))
        for m in {int(x) for x in np.diff(w.bound) if 0 < x < span}:
            grams, at = shingle_hashes(w, m)
            for h, r in zip(grams.tolist(), w.row[at].tolist(), strict=True):
                if w.bound[r + 1] - w.bound[r] == m:
                    block.short.setdefault(m, {}).setdefault(h, []).append(str(rows[w.first + r][0]))
    if prints:
        block.prints, block.places = np.concatenate(prints), np.concatenate(places)
        order = np.argsort(block.prints, kind="stable")
        block.prints, block.places = block.prints[order], block.places[order]
    return block


def find_hits(w: Words, block: Block, k: int = K) -> tuple[np.ndarray, dict[int, set[str]]]:
    """(whether each word is hit, names of the items found in each row)."""
    hit = np.zeros(len(w.hash) + 1, dtype=np.int64)  # differences
    found: dict[int, set[str]] = {}
    hashes, at = fingerprints(w, block.span, k)
    if len(block.prints) and len(at):
        low = np.searchsorted(block.prints, hashes, side="left")
        high = np.searchsorted(block.prints, hashes, side="right")
        some = np.flatnonzero(high > low)
        seen: set[tuple[int, int, int]] = set()
        for i in some.tolist():
            p = int(at[i])
            r = int(w.row[p])
            for item, j in block.places[low[i] : high[i]].tolist():
                d = p - j
                # A diagonal of one row and item is extended once, over its whole length.
                if (r, item, d) in seen:
                    continue
                seen.add((r, item, d))
                words = block.words[item]
                a, b = max(int(w.bound[r]), d), min(int(w.bound[r + 1]), d + len(words))
                equal = np.concatenate(([False], w.hash[a:b] == words[a - d : b - d], [False]))
                edge = np.flatnonzero(equal[1:] != equal[:-1])
                for x, y in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                    if y - x >= block.span:
                        hit[a + x] += 1
                        hit[a + y] -= 1
                        found.setdefault(r, set()).add(block.names[item])
    for m, names in block.short.items():
        grams, at = shingle_hashes(w, m)
        whole = np.diff(w.bound)[w.row[at]] >= m
        grams, at = grams[whole], at[whole]
        for i in np.flatnonzero(np.isin(grams, np.fromiter(names, dtype=np.uint64))).tolist():
            p = int(at[i])
            hit[p] += 1
            hit[p + m] -= 1
            found.setdefault(int(w.row[p]), set()).update(names[int(grams[i])])
    return np.cumsum(hit)[:-1] > 0, found


def _scan(block, kind: pa.Schema) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("_text")
            for w in word_slices(batch.column(at), ALNUM):
                part = batch.slice(w.first, w.rows)
                hit, found = find_hits(w, block.value)
                spans = [_spans(hit[w.bound[r] : w.bound[r + 1]]) for r in range(w.rows)]
                items = [sorted(found.get(r, ())) for r in range(w.rows)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.diff(w.bound), pa.int64()), pa.array(spans, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))], schema=kind)

    return run


def _spans(mask: np.ndarray) -> list[int]:
    """Starts and ends, in turn, of the runs that are set."""
    mask = np.concatenate(([False], mask, [False]))
    return np.flatnonzero(mask[1:] != mask[:-1]).tolist()


def _prints(span: int, short: tuple[int, ...] | None, known=None, k: int = K) -> Callable:
    """(m, hash, id, place) from rows (id, text): winnowed fingerprints as m = 0, and runs of m words.

    Of items (short None) a text of fewer than `span` words gives itself as its only run; of
    documents, all runs of the lengths in `short` are given, and of all of these only those
    that may be in the filter `known`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for w in word_slices(batch.column(1), ALNUM):
                count = np.diff(w.bound)
                hashes, at = fingerprints(w, span, k)
                parts = [(np.zeros(len(at), np.int32), hashes, at)]
                for m in sorted({int(x) for x in count if 0 < x < span}) if short is None else short:
                    hashes, at = shingle_hashes(w, m)
                    fits = count[w.row[at]] == m if short is None else count[w.row[at]] >= m
                    parts.append((np.full(int(fits.sum()), m, np.int32), hashes[fits], at[fits]))
                m, hashes, at = (np.concatenate([p[i] for p in parts]) for i in range(3))
                if known is not None:
                    some = _maybe(known.value, hashes)
                    m, hashes, at = m[some], hashes[some], at[some]
                row = w.row[at]
                yield pa.RecordBatch.from_arrays([pa.array(m, pa.int32()), pa.array(hashes.astype(np.int64)), pa.array(ids[w.first + row]), pa.array((at - w.bound[row]).astype(np.int32))], ["m", "hash", "id", "place"])

    return run


def _extended(span: int) -> Callable:
    """(rid, item, spans) from rows (rid, item, m, diagonals, text, item_text): runs of equal words along the diagonals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, diagonals = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            mine = [(w, r) for w in word_slices(batch.column(4), ALNUM) for r in range(w.rows)]
            theirs = [(w, r) for w in word_slices(batch.column(5), ALNUM) for r in range(w.rows)]
            keep, spans = [], []
            for i, ((v, r), (w, q)) in enumerate(zip(mine, theirs, strict=True)):
                x, y = v.hash[v.bound[r] : v.bound[r + 1]], w.hash[w.bound[q] : w.bound[q + 1]]
                least, hit = lengths[i] or span, np.zeros(len(x), dtype=bool)
                for d in diagonals[i]:
                    a, b = max(0, d), min(len(x), d + len(y))
                    found = _spans(x[a:b] == y[a - d : b - d])
                    for s, e in zip(found[::2], found[1::2], strict=True):
                        if e - s >= least:
                            hit[a + s : a + e] = True
                if hit.any():
                    keep.append(i)
                    spans.append(_spans(hit))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), batch.column(1).take(pa.array(keep, pa.int64())), pa.array(spans, pa.list_(pa.int32()))], ["rid", "item", "spans"])

    return run


def _known(prints: DataFrame) -> np.ndarray:
    """A filter of 2 MB: bits of the hashes of items; a document's hash without its bit is none of theirs."""
    bit = F.col("hash").bitwiseAND((1 << FILTER_BITS) - 1)
    words = prints.groupBy(F.shiftright(bit, 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(hash & 63 AS INT))")).alias("bits")).toPandas()
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    out[words["word"].to_numpy(dtype=np.int64)] = words["bits"].to_numpy(dtype=np.int64)
    return out.view(np.uint64)


def _maybe(known: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    h = hashes.astype(np.int64).view(np.uint64)
    at = h & np.uint64((1 << FILTER_BITS) - 1)
    return (known[(at >> np.uint64(6)).astype(np.int64)] >> (h & np.uint64(63))) & np.uint64(1) == 1


def _joined(docs: DataFrame, items: DataFrame, span: int) -> DataFrame:
    """docs (with _text) and _words, _spans, _items, by joining fingerprints."""
    spark = docs.sparkSession
    docs = written(docs.withColumn("_rid", F.monotonically_increasing_id()), "leak-docs")
    items = written(items.withColumn("iid", F.monotonically_increasing_id()), "leak-items")
    schema = "m int, hash long, id long, place int"
    theirs = written(items.select("iid", "text").mapInArrow(_prints(span, None), schema), "leak-prints")
    short = tuple(sorted(r.m for r in theirs.filter("m > 0").select("m").distinct().collect()))  # below span
    mine = docs.select("_rid", "_text").mapInArrow(_prints(span, short, spark.sparkContext.broadcast(_known(theirs))), schema)
    # A hash of common words has many places in documents: they meet its items in several tasks.
    salted = theirs.toDF("m", "hash", "iid", "q").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = mine.toDF("m", "hash", "rid", "p").withColumn("salt", F.pmod(F.xxhash64("rid"), F.lit(SALTS)).cast("int")).join(salted, ["m", "hash", "salt"])
    met = met.select("rid", "iid", "m", (F.col("p") - F.col("q")).alias("d")).distinct().groupBy("rid", "iid", "m").agg(F.collect_list("d").alias("diagonals"))
    pairs = written(met, "leak-pairs")
    texts = pairs.join(docs.select(F.col("_rid").alias("rid"), F.col("_text").alias("text")), "rid").join(items.select("iid", "item_id", F.col("text").alias("item_text")), "iid")
    hits = written(texts.select("rid", F.col("item_id").alias("item"), "m", "diagonals", "text", "item_text").mapInArrow(_extended(span), "rid long, item string, spans array<int>"), "leak-hits")
    ends = F.transform(F.sequence(F.lit(0), (F.size("spans") / 2 - 1).cast("int")), lambda i: F.struct(F.element_at("spans", i * 2 + 1).alias("a"), F.element_at("spans", i * 2 + 2).alias("b")))
    hits = hits.select("rid", "item", ends.alias("ends"))
    of = hits.groupBy("rid").agg(F.array_sort(F.flatten(F.collect_list("ends"))).alias("ends"), F.array_sort(F.collect_set("item")).alias("items"))
    # Overlapping and touching spans, in order, become one: (spans so far, the last one's end).
    start = F.struct(F.array().cast("array<int>").alias("done"), F.lit(-1).alias("a"), F.lit(-1).alias("b"))

    def step(s, x):
        apart = F.struct(F.when(s["b"] >= 0, F.concat(s["done"], F.array(s["a"], s["b"]))).otherwise(s["done"]).alias("done"), x["a"].alias("a"), x["b"].alias("b"))
        return F.when((s["b"] >= 0) & (x["a"] <= s["b"]), F.struct(s["done"].alias("done"), s["a"].alias("a"), F.greatest(s["b"], x["b"]).alias("b"))).otherwise(apart)

    merged = F.aggregate("ends", start, step, lambda s: F.concat(s["done"], F.array(s["a"], s["b"])))
    of = of.select(F.col("rid").alias("_r"), merged.alias("_spans"), F.col("items").alias("_items"))
    none = F.array().cast("array<int>"), F.array().cast("array<string>")
    out = docs.join(of, F.col("_rid") == F.col("_r"), "left")
    words = F.size(F.regexp_extract_all(F.coalesce("_text", F.lit("")), F.lit("([^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+)"), F.lit(1)))
    return out.select(*(c for c in docs.columns if c != "_rid"), words.cast("long").alias("_words"), F.coalesce("_spans", none[0]).alias("_spans"), F.coalesce("_items", none[1]).alias("_items"))


def contamination(docs: DataFrame, benchmark: DataFrame, span: int = 10, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per row of docs: the columns `keep`, then _text, _words, _spans and _items.

    _words counts words, _spans holds starts and ends (in words, in turn) of the merged
    runs that are hit, _items the sorted names of items found. A null text has no words.
    Items with a null id or without words are not looked for; rows with the same item id
    are one item with several texts.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    spark = docs.sparkSession
    items = benchmark.filter("item_id is not null and text is not null").select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    out = docs.select(*keep, F.col("text").cast("string").alias("_text"))
    if size > BLOCK_BYTES:
        return _joined(out, items, span)
    kind = StructType([*out.schema.fields, *StructType.fromDDL("_words long, _spans array<int>, _items array<string>").fields])
    block = spark.sparkContext.broadcast(block_of([(r.item_id, r.text) for r in items.collect()], span))
    return out.mapInArrow(_scan(block, to_arrow_schema(kind)), kind)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans, items = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        hit = [sum(x[1::2]) - sum(x[::2]) for x in spans]
        hashed = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]
        columns = [batch.column(0), batch.column(1), pa.array(hit, pa.int64()), pa.array([len(x) for x in items], pa.int64()), pa.array(hashed, pa.string()), pa.array([h > 0 for h in hit], pa.bool_())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])


def decontamination_report(docs: DataFrame, benchmark: DataFrame, span: int = 10) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Words are runs of ASCII letters, digits and all characters beyond ASCII, A-Z lower-cased.
    A word is hit if it lies in an occurrence of `span` consecutive words of an item, or of a
    whole item of fewer words. Empty and null texts have no words and no hits; ids pass as
    they are, null or repeated; empty tables give no rows or no hits. Other columns play no part.
    """
    return contamination(docs, benchmark, span).select("doc_id", "_words", "_spans", "_items").mapInArrow(_digest, RESULT.replace("doc_id long", f"doc_id {docs.schema['doc_id'].dataType.simpleString()}"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, span: int = 10) -> DataFrame:
    """docs without the rows that hold a hit; every column stays as it is."""
    hits = contamination(packed(docs), benchmark, span, ("row",))
    return hits.filter(F.size("_spans") == 0).select("row.*")


def op2_winnowed_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination_report(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def leaks_sql(documents: str = "documents", benchmark: str = "benchmark", span: int = 10) -> str:
    words = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, {words} AS w FROM {documents}
), i AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, {words} AS w FROM {benchmark} WHERE item_id IS NOT NULL
), grams AS (
  SELECT DISTINCT item_id, m, array_to_string(w[p:p + m - 1], ' ') AS g
  FROM (SELECT item_id, w, least(len(w), {span}) AS m, unnest(range(1, len(w) - least(len(w), {span}) + 2)) AS p FROM i WHERE len(w) > 0)
), lengths AS (
  SELECT DISTINCT m FROM grams
), runs AS (
  SELECT rid, m, p, array_to_string(w[p:p + m - 1], ' ') AS g
  FROM (SELECT rid, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM d, lengths WHERE len(w) >= m)
), hits AS (
  SELECT r.rid, r.m, r.p, g.item_id FROM runs r JOIN grams g ON r.m = g.m AND r.g = g.g
), hit AS (
  SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT DISTINCT rid, unnest(range(p, p + m)) AS q FROM hits) GROUP BY rid
), items AS (
  SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names FROM (SELECT DISTINCT rid, item_id FROM hits) GROUP BY rid
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN items USING (rid)"""


QUERIES = {"op2_winnowed_leaks": op2_winnowed_leaks}
ORACLE = {"op2_winnowed_leaks": leaks_sql()}
