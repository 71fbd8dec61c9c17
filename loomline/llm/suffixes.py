"""Removal of repeated byte strings by blockwise suffix sorting over a cover sample.

A cover is a set of places such that any two equal strings of LENGTH bytes have a place of
it at the same distance from their starts, less than v. Here it is chosen by content, as the
least hash of GRAM bytes in each string, so that v = LENGTH - GRAM + 1; one place in about
v / 2 belongs to it. Suffixes that have the same gram at that place are one bucket. Buckets
are sorted a block at a time: the suffixes of their cover places first, which gives each a
rank with the common prefix of neighbours, and then, for each distance below v, the strings
that start so far before them, by what stands before the place and, on ties, by that rank.
Grams that occur once are dropped before any text is moved.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes of a repeated string.
LENGTH = 100
#: Bytes of text that a cell of documents has on average, and string starts hashed at once.
CELL_BYTES = 8 << 20
CHUNK = 1 << 20
#: Suffixes sorted at once; a bucket of more than HOT is cut by whole strings.
BLOCK = 1 << 16
HOT = 10_000

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_RECORD = "fp long, doc_id long, cell int, idx int, at long, left int, windows int, context binary"


def gram(length: int) -> int:
    return max(1, length // 3)


def gram_hashes(text: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of all strings of k bytes, as polynomials put together from halves, mixed."""
    part, size = text.astype(np.uint64) + np.uint64(1), 1
    out, width = None, 0
    while True:
        if k & size:
            if out is None:
                out, width = part, size
            else:
                n = len(text) - width - size + 1
                out = out[:n] * np.uint64(pow(_BASE, size, 1 << 64)) + part[width : width + n]
                width += size
        if 2 * size > k:
            break
        n = len(text) - 2 * size + 1
        part = part[:n] * np.uint64(pow(_BASE, size, 1 << 64)) + part[size : size + n]
        size *= 2
    out = out ^ (out >> np.uint64(29))
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out


def cover_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(hash, place, first, last) of cover places in texts that lie in data at starts to ends.

    Strings of length bytes that begin at first to last have their least gram at place. A
    string's place follows from its bytes alone, so the text may be cut anywhere.
    """
    k = gram(length)
    width = length - k + 1
    whole = ends - starts >= length
    edge = np.zeros(len(data) + 1, np.int8)
    edge[starts[whole]] += 1
    edge[ends[whole] - length + 1] -= 1
    valid = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    for a in range(0, len(data) - length + 1, CHUNK):
        ok = valid[a : min(a + CHUNK, len(data) - length + 1)]
        if not ok.any():
            continue
        hashes = gram_hashes(data[a : a + len(ok) + length - 1], k)
        # The upper half of the hash and the place: of equal ones the first counts.
        least = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
        size = 1
        while 2 * size <= width:
            least = np.minimum(least[: len(least) - size], least[size:])
            size *= 2
        least = np.minimum(least[: len(ok)], least[width - size : width - size + len(ok)])
        place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        cut = np.flatnonzero((place[1:] != place[:-1]) | (ok[1:] != ok[:-1])) + 1
        first, last = np.concatenate(([0], cut)), np.concatenate((cut, [len(ok)])) - 1
        first, last = first[ok[first]], last[ok[first]]
        at = place[first]
        yield hashes[at].view(np.int64), at + a, first + a, last + a


def _laid(table: pa.Table) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray, bytes]:
    """Rows of a cell in order of doc_id, null last, and text; their starts and ends in the joined bytes."""
    ids = table.column("doc_id").to_pylist()
    texts = table.column("text").to_pylist()
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i]))
    ends = np.cumsum([len(texts[i]) for i in order], dtype=np.int64)
    joined = b"".join(texts[i] for i in order)
    starts = np.concatenate((np.zeros(1, np.int64), ends[:-1]))
    return [ids[i] for i in order], starts, ends, np.frombuffer(joined, np.uint8), joined


def _grams(length: int):
    def run(table: pa.Table) -> pa.Table:
        _, starts, ends, data, _ = _laid(table)
        found = [x[0] for x in cover_runs(data, starts, ends, length)] or [np.zeros(0, np.int64)]
        fps, n = np.unique(np.concatenate(found), return_counts=True)
        cell = pa.repeat(table.column("cell")[0], len(fps))
        return pa.table({"fp": pa.array(fps, pa.int64()), "cell": cell.cast(pa.int32()), "n": pa.array(n, pa.int64())})

    return run


def _opened(length: int):
    """Records of the cover places whose gram occurs elsewhere. A later equal one in the cell is removed at once: it has no context."""

    def run(docs: pa.Table, open_: pa.Table) -> pa.Table:
        out: list[list] = [[] for _ in range(8)]
        if docs.num_rows and open_.num_rows:
            cell = docs.column("cell")[0].as_py()
            fps, total = open_.column("fp").to_numpy(), open_.column("total").to_numpy()
            order = np.argsort(fps)
            fps, total = fps[order], total[order]
            ids, starts, ends, data, joined = _laid(docs)
            seen: set = set()
            for fp, at, first, last in cover_runs(data, starts, ends, length):
                slot = np.minimum(np.searchsorted(fps, fp), len(fps) - 1)
                keep = np.flatnonzero(fps[slot] == fp)
                # Empty texts begin where the next one does; the last of these holds the bytes.
                doc = np.searchsorted(starts, first[keep], "right") - 1
                hot = total[slot[keep]] > HOT
                for f, p, a, b, d, h in zip(fp[keep].tolist(), at[keep].tolist(), first[keep].tolist(), last[keep].tolist(), doc.tolist(), hot.tolist(), strict=True):
                    context, base = joined[a : b + length], int(starts[d])
                    if (p - a, context) in seen:
                        rows = [((cell * 1_000_003 + d) * 1_000_003 + p & _MASK >> 1, p, a, b, None)]
                    elif h and a < b:
                        seen.add((p - a, context))
                        rows = []
                        for i in range(a, b + 1):
                            string = joined[i : i + length]
                            key = int.from_bytes(hashlib.blake2b(string, digest_size=8).digest(), "little", signed=True)
                            known = (p - i, string) in seen
                            seen.add((p - i, string))
                            rows.append((key, p, i, i, None if known else string))
                    else:
                        seen.add((p - a, context))
                        rows = [(int.from_bytes(hashlib.blake2b(context, digest_size=8).digest(), "little", signed=True) if h else f, p, a, b, context)]
                    for key, p, a, b, context in rows:
                        for column, x in zip(out, (key, ids[d], cell, d, p - base, p - a, b - a + 1, context), strict=True):
                            column.append(x)
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        return pa.table([pa.array(x, kind) for x, kind in zip(out, kinds, strict=True)], names=["fp", "doc_id", "cell", "idx", "at", "left", "windows", "context"])

    return run


def _words(rows: np.ndarray) -> list[np.ndarray]:
    """The columns of rows (of bytes, a multiple of eight) as big-endian numbers, eight bytes each."""
    words = rows.view(">u8")
    return [words[:, i].astype(np.uint64) for i in range(words.shape[1])]


def _ranked(rows: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows within buckets, and the bytes that each has in common with the one before (-1: another bucket)."""
    order = np.lexsort((*reversed(_words(rows)), bucket))
    stand = rows[order]
    common = np.full(len(rows), -1, np.int64)
    differ = stand[1:] != stand[:-1]
    common[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    changed = bucket[order]
    common[1:][changed[1:] != changed[:-1]] = -1
    return order, common


def _padded(parts: list[bytes], width: int) -> np.ndarray:
    size = -(-width // 8) * 8
    return np.frombuffer(b"".join(x.ljust(size, b"\0") for x in parts), np.uint8).reshape(len(parts), size)


def earlier_strings(bucket: np.ndarray, rank: np.ndarray, left: np.ndarray, windows: np.ndarray, contexts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Per record the least and greatest distance at which its string also starts earlier, by rank; -1 for none.

    Texts are filled up with zero bytes; only records that hold a string whole are asked
    for it, so these never count. Of n records, 2 sorts of suffixes and one of n numbers for
    each distance are made.
    """
    n = len(bucket)
    low, high = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    after, in_after = _ranked(_padded([x[a : a + length] for x, a in zip(contexts, left.tolist(), strict=True)], length), bucket)
    before, in_before = _ranked(_padded([x[:a][::-1] for x, a in zip(contexts, left.tolist(), strict=True)], length), bucket)
    by_rank = np.argsort(rank)
    place = np.empty(n, np.uint64)
    place[by_rank] = np.arange(n, dtype=np.uint64)
    bits = np.uint64(max(1, n.bit_length()))
    least = left - windows + 1
    one, other = np.empty(n, np.uint64), np.empty(n, np.uint64)
    for j in range(int(least.min()), int(left.max()) + 1):
        asked = np.flatnonzero((least <= j) & (j <= left))
        if len(asked) < 2:
            continue
        one[before] = np.cumsum(in_before < j)
        other[after] = np.cumsum(in_after < length - j)
        key = np.sort((((one[asked] << bits) | other[asked]) << bits) | place[asked])
        again = key[1:][(key[1:] >> bits) == (key[:-1] >> bits)]
        found = by_rank[(again & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)]
        low[found[low[found] < 0]] = j
        high[found] = j
    return low, high


def _fold(table: pa.Table) -> tuple[pa.Table, pa.Table]:
    """The earliest of records that are alike in all but their place, and the others."""
    first: dict = {}
    rest = []
    order = _rank(table)
    for i, key in enumerate(zip(table.column("fp").to_pylist(), table.column("left").to_pylist(), table.column("context").to_pylist(), strict=True)):
        old = first.setdefault(key, i)
        if old != i:
            first[key] = min(i, old, key=order.__getitem__)
            rest.append(max(i, old, key=order.__getitem__))
    return table.take(sorted(first.values())), table.take(rest)


def _rank(table: pa.Table) -> np.ndarray:
    """Places of records in the order of doc_id (null last), cell, row and place."""
    ids = table.column("doc_id")
    keys = (table.column("at").to_numpy(), table.column("idx").to_numpy(), table.column("cell").to_numpy(), ids.fill_null(0).to_numpy(), ids.is_null().to_numpy())
    rank = np.empty(table.num_rows, np.int64)
    rank[np.lexsort(keys)] = np.arange(table.num_rows)
    return rank


def _spans(table: pa.Table, low: np.ndarray, high: np.ndarray, length: int) -> pa.RecordBatch:
    found = np.flatnonzero(high >= 0)
    at = table.column("at").to_numpy()[found]
    taken = [table.column(c).combine_chunks().take(pa.array(found)) for c in ("cell", "idx")]
    return pa.RecordBatch.from_arrays([*taken, pa.array(at - high[found], pa.int64()), pa.array(at - low[found] + length, pa.int64())], names=["cell", "idx", "a", "b"])


def _sorted_blocks(length: int):
    def whole(table: pa.Table) -> pa.RecordBatch:
        left, windows = (table.column(c).to_numpy().astype(np.int64) for c in ("left", "windows"))
        return _spans(table, left - windows + 1, left, length)

    def block(table: pa.Table) -> pa.RecordBatch:
        fp = table.column("fp").to_numpy()
        bucket = np.concatenate(([0], np.cumsum(fp[1:] != fp[:-1])))
        left, windows = (table.column(c).to_numpy().astype(np.int64) for c in ("left", "windows"))
        low, high = earlier_strings(bucket, _rank(table), left, windows, table.column("context").to_pylist(), length)
        return _spans(table, low, high, length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            more = pa.Table.from_batches([batch])
            done = more.filter(more.column("context").is_null())
            if done.num_rows:
                yield whole(done)
            more = more.filter(more.column("context").is_valid())
            held = more if held is None else pa.concat_tables([held, more]).combine_chunks()
            if held.num_rows >= BLOCK:
                fp = held.column("fp").to_numpy()
                cut = int(np.flatnonzero(fp == fp[-1])[0])  # the last bucket may go on
                if cut:
                    yield block(held.slice(0, cut).combine_chunks())
                    held = held.slice(cut).combine_chunks()
                else:
                    held, rest = _fold(held)
                    if rest.num_rows:
                        yield whole(rest)
        if held is not None and held.num_rows:
            yield block(held)

    return run


def _kept(docs: pa.Table, spans: pa.Table) -> Iterator[tuple[int | None, bytes, list[tuple[int, int]]]]:
    """doc_id, bytes and merged removed runs of each row of a cell."""
    ids, starts, ends, _, joined = _laid(docs)
    by_row: dict[int, list[tuple[int, int]]] = {}
    for i, a, b in sorted(zip(*(spans.column(c).to_pylist() for c in ("idx", "a", "b")), strict=True)):
        runs = by_row.setdefault(i, [])
        if runs and a <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(b, runs[-1][1]))
        else:
            runs.append((a, b))
    for i, doc in enumerate(ids):
        yield doc, joined[starts[i] : ends[i]], by_row.get(i, [])


def _left(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for a, b in runs:
        out.append(text[at:a])
        at = b
    return b"".join([*out, text[at:]])


def _removed(docs: pa.Table, spans: pa.Table) -> pa.Table:
    """Texts that stay. Characters that lose some of their bytes lose all, so that what stays is text."""
    out: list[list] = [[], [], []]
    for doc, text, runs in _kept(docs, spans):
        for column, x in zip(out, (doc, _left(text, runs).decode("utf-8", "ignore"), [{"start": a, "end": b} for a, b in runs]), strict=True):
            column.append(x)
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.list_(span))], names=["doc_id", "text", "spans"])


def _digest(docs: pa.Table, spans: pa.Table) -> pa.Table:
    rows = [(doc, len(text), sum(b - a for a, b in runs), len(runs), hashlib.sha256(_left(text, runs)).hexdigest()) for doc, text, runs in _kept(docs, spans)]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return pa.table([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=names)


def _cells(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) with the number of a cell, of CELL_BYTES on average, that follows from id and text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cells = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // CELL_BYTES), 1)
    return rows.withColumn("cell", F.pmod(F.xxhash64("doc_id", "text"), F.lit(cells)).cast("int"))


def _earlier(rows: DataFrame, length: int) -> DataFrame:
    """(cell, idx, a, b): bytes a to b of the idx-th row of a cell are covered by strings that also start earlier."""
    if not 2 <= length <= 1000:
        raise ValueError("strings of 2 to 1000 bytes")
    grams = rows.groupBy("cell").applyInArrow(_grams(length), "fp long, cell int, n long")
    # A gram has one row per cell that holds it, so no gram has more rows than there are cells.
    total = grams.withColumn("total", F.sum("n").over(Window.partitionBy("fp"))).filter("total > 1").drop("n")
    records = rows.groupBy("cell").cogroup(total.groupBy("cell")).applyInArrow(_opened(length), _RECORD)
    ranked = records.repartition("fp").sortWithinPartitions("fp")
    return ranked.mapInArrow(_sorted_blocks(length), "cell int, idx int, a long, b long")


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, text and spans: docs (doc_id, text) without bytes covered by a string of length bytes that also starts earlier.

    Earlier is the order of doc_id, null last, and of places in a text. Rows of one id are
    documents of their own, in a fixed order; of repeated rows one stays whole. spans are
    the removed runs in UTF-8 bytes; a character of which some bytes go is not kept. Null
    texts count as empty; texts shorter than length stay; an empty table gives an empty
    one; other columns play no part.
    """
    rows = _cells(docs)
    spans = _earlier(rows, length)
    return rows.groupBy("cell").cogroup(spans.groupBy("cell")).applyInArrow(_removed, "doc_id long, text string, spans array<struct<start:long,end:long>>")


def repeat_digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the hash of the remaining bytes, by the rules of remove_repeats."""
    rows = _cells(docs)
    spans = _earlier(rows, length)
    return rows.groupBy("cell").cogroup(spans.groupBy("cell")).applyInArrow(_digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op12_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op12_suffix_repeats": op12_suffix_repeats}
ORACLE: dict[str, str] = {}
