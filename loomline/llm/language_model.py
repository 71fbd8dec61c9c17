"""Hashed maximum-entropy language model with class-factored softmax.

A token's probability is that of its class after the words before it, times that of its
place in the class after the same words. Both factors are log-linear: a bias, the word
before (bigram), the ones two and three before (skips), and the last two together (trigram,
hashed); within a class the features are hashed along with the class. The most frequent
words have places of their own. All others share a last place in each class by the bytes
they end with, and have their smoothed share of its count. Words that stand next to alike
words are put into one class.

Counts, neighbours and gradients come from all training tokens. Each round of updates is
spread over trainers, which go through their own texts once; the weights of a feature are
then averaged over them by how often each saw it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.llm.shared import written
from loomline.llm.words import SPACED, Words, mix, word_slices

#: Classes, and places in a class, the last one of which all rarer words share.
SIDE = 48
SUFFIXES = 512
#: Hashed neighbours, on either side, by which words are put into classes.
NEIGHBOURS = 64
#: Rows of the hashed features of classes and of places.
TRIGRAMS = 1 << 14
WITHIN = 1 << 15
#: Words whose counts every task holds; the counts of the others are joined.
FREQUENT = 1 << 18
#: Rounds of updates; each training text takes part in one of them.
ROUNDS = 1
RATE = 0.12
BATCH = 8192
#: Bytes of input that one trainer goes through at least, where all cores have work.
TRAINER_BYTES = 256 << 20
END = np.int64(-1)
_ABSENT = np.float32(-1e9)
_U = np.uint64


def tokens_of(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, suffix, row, bound) of all tokens of a slice: the words of each row, then its end.

    The suffix is a hash of the last three bytes.
    """
    words = len(w.hash)
    count = np.diff(w.bound)
    bound = w.bound + np.arange(w.rows + 1)
    at = np.arange(words) + w.row
    total = words + w.rows
    hashes = np.full(total, END, dtype=np.int64)
    suffix = np.full(total, -1, dtype=np.int64)
    own = w.hash.astype(np.int64)
    own[own == END] = 0
    hashes[at] = own
    if words:
        length = w.end - w.start
        last = w.data[w.end - 1].astype(np.int64)
        for k, base in ((2, 257), (3, 65_537)):
            last += np.where(length >= k, w.data[np.maximum(w.end - k, 0)].astype(np.int64) + 1, 0) * base
        suffix[at] = (mix(last.astype(np.uint64)) % _U(SUFFIXES)).astype(np.int64)
    row = np.repeat(np.arange(w.rows), count + 1)
    return hashes, suffix, row, bound


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, suffix, count) of a task's tokens, added up while they fit."""
    waiting: list[np.ndarray] = []
    kinds: list[np.ndarray] = []
    held = 0
    words, suffixes, counts = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)

    def add_up():
        h = np.concatenate([words, *waiting])
        s = np.concatenate([suffixes, *kinds])
        n = np.concatenate([counts, *(np.ones(len(x), np.int64) for x in waiting)])
        found, first, place = np.unique(h, return_index=True, return_inverse=True)
        waiting.clear()
        kinds.clear()
        return found, s[first], np.bincount(place, weights=n, minlength=len(found)).astype(np.int64)

    def out():
        return pa.RecordBatch.from_arrays([pa.array(words), pa.array(suffixes, pa.int32()), pa.array(counts)], ["word", "suffix", "n"])

    for batch in batches:
        for w in word_slices(batch.column(0), SPACED):
            h, s, _, _ = tokens_of(w)
            waiting.append(h)
            kinds.append(s.astype(np.int32))
            held += len(h)
            if held > 1_500_000:
                words, suffixes, counts = add_up()
                held = 0
                if len(words) > 1_500_000:
                    yield out()
                    words, suffixes, counts = words[:0], suffixes[:0], counts[:0]
    words, suffixes, counts = add_up()
    yield out()


@dataclass
class LanguageModel:
    """Units are the own words by falling count, then the suffixes of all other words."""

    own: np.ndarray  # sorted hashes of the words with places of their own
    own_unit: np.ndarray  # their units
    own_log: np.ndarray  # log10(count + 1) by unit
    unit_class: np.ndarray
    unit_place: np.ndarray
    rest: np.ndarray  # log10 of each class's smoothed count of words without own places
    frequent: np.ndarray  # sorted hashes
    frequent_log: np.ndarray  # log10(count + 1)
    by_class: np.ndarray  # weights: features x classes
    by_place: np.ndarray  # weights: hashed features x places; the first rows are the classes' biases

    def frequent_at(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(where a frequent word would stand, whether it does), by the hashes' first bits and a few steps from there."""
        at = self.starts[(hashes >> np.int64(64 - self.bits)) + (1 << (self.bits - 1))]
        last = max(len(self.frequent) - 1, 0)
        for _ in range(self.reach):
            behind = np.flatnonzero((self.frequent[np.minimum(at, last)] < hashes) & (at < last))
            if not len(behind):
                break
            at[behind] += 1
        at = np.minimum(at, last)
        return at, self.frequent[at] == hashes

    def __post_init__(self):
        self.bits = max(1, len(self.frequent).bit_length())
        edges = (np.arange(1 << self.bits, dtype=np.int64) - (1 << (self.bits - 1))) << np.int64(64 - self.bits)
        self.starts = np.searchsorted(self.frequent, edges)
        self.reach = int(np.diff(np.append(self.starts, len(self.frequent))).max(initial=0)) + 1

    def units(self, hashes: np.ndarray, suffix: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.own, hashes), len(self.own) - 1)
        return np.where(self.own[at] == hashes, self.own_unit[at], len(self.own) + np.maximum(suffix, 0))


def contexts(units: np.ndarray, bound: np.ndarray, start: int) -> list[np.ndarray]:
    """The units one, two and three before each token; `start` before a text."""
    out = []
    place = np.arange(len(units)) - np.repeat(bound[:-1], np.diff(bound))
    for k in (1, 2, 3):
        before = np.full(len(units), start, dtype=np.int64)
        before[k:] = units[:-k]
        before[place < k] = start
        out.append(before)
    return out


def features(before: list[np.ndarray], units: int) -> list[np.ndarray]:
    """Rows of the class weights that are active, besides the bias in row 0."""
    one, two, three = before
    pair = mix((one * (units + 1) + two).astype(np.uint64)) % _U(TRIGRAMS)
    return [1 + one, 2 + units + two, 3 + 2 * units + three, 4 + 3 * units + pair.astype(np.int64)]


def place_features(before: list[np.ndarray], classes: np.ndarray, units: int) -> list[np.ndarray]:
    """Rows of the place weights that are active in these classes, the bias of the class first."""
    one, two, _ = before
    kinds = (one, two, one * (units + 1) + two)
    keys = [mix((x * SIDE + classes).astype(np.uint64) * _U(4) + _U(k)) % _U(WITHIN) for k, x in enumerate(kinds)]
    return [classes, *(SIDE + k.astype(np.int64) for k in keys)]


def n_features(units: int) -> int:
    return 4 + 3 * units + TRIGRAMS


class Room:
    """Two blocks of a batch's size that are used again and again."""

    def __init__(self, width: int):
        self.z, self.more = (np.empty((BATCH, width), dtype=np.float32) for _ in range(2))
        self.ones = np.ones(width, dtype=np.float32)

    def exponents(self, weights: np.ndarray, rows: list[np.ndarray], bias: bool) -> np.ndarray:
        """The sums of the weights' rows, less their largest entries; valid until the next call."""
        n = len(rows[0])
        z, more = self.z[:n], self.more[:n]
        np.take(weights, rows[0], axis=0, out=z, mode="clip")
        for r in rows[1:]:
            np.take(weights, r, axis=0, out=more, mode="clip")
            z += more
        if bias:
            z += weights[0]
        z -= z.max(axis=1, keepdims=True)
        return z

    def log_probability(self, weights: np.ndarray, rows: list[np.ndarray], bias: bool, aim: np.ndarray) -> np.ndarray:
        """Natural log of the softmax at one entry of each row."""
        z = self.exponents(weights, rows, bias)
        chosen = z[np.arange(len(z)), aim]
        np.exp(z, out=z)
        return chosen - np.log(z @ self.ones)

    def gradient(self, weights: np.ndarray, rows: list[np.ndarray], bias: bool, aim: np.ndarray) -> np.ndarray:
        """The softmax, less 1 at the entry aimed at."""
        z = self.exponents(weights, rows, bias)
        np.exp(z, out=z)
        z /= (z @ self.ones)[:, None]
        z[np.arange(len(z)), aim] -= 1
        return z


def _neighbours(model) -> Callable:
    """(row, values): how often hashed words stand before and after each unit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        width = 2 * NEIGHBOURS
        total = np.zeros(len(m.unit_class) * width)
        for batch in batches:
            for w in word_slices(batch.column(0), SPACED):
                h, s, row, _ = tokens_of(w)
                u = m.units(h, s) * width
                g = (mix(h.astype(np.uint64)) % _U(NEIGHBOURS)).astype(np.int64)
                same = row[1:] == row[:-1]
                keys = np.concatenate(((u[1:] + g[:-1])[same], (u[:-1] + NEIGHBOURS + g[1:])[same]))
                total += np.bincount(keys, minlength=len(total))
        yield _vectors(total.reshape(-1, width))

    return run


def _vectors(rows: np.ndarray) -> pa.RecordBatch:
    some = np.flatnonzero(rows.any(axis=1))
    return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([x.tobytes() for x in rows[some].astype(np.float32)], pa.binary())], ["row", "values"])


def _add_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for r, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            v = np.frombuffer(x.as_buffer(), dtype=np.float32).astype(np.float64)
            sums[r] = sums[r] + v if r in sums else v
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["row", "values"])


def _summed(vectors: DataFrame, rows: int, width: int) -> np.ndarray:
    """The sum of all tasks' vectors by row, a table of the model's size."""
    out = np.zeros((rows, width))
    for r in vectors.repartition("row").mapInArrow(_add_vectors, "row int, values binary").collect():
        out[r.row] = np.frombuffer(r.values)
    return out


def word_classes(near: np.ndarray, own: int, side: int = SIDE, rounds: int = 10, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(class, place) of each unit: own words, by falling count, in classes of side - 1 at most, suffixes at their last places.

    Units with like neighbours stand together; the centres are found by a few rounds of means.
    """
    count = near.sum(axis=1)
    x = np.sqrt(near / np.maximum(count, 1)[:, None]) - np.sqrt(near.sum(axis=0) / max(near.sum(), 1))
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    centres = x[np.random.default_rng(seed).choice(own, side, replace=own < side)]
    weight = np.sqrt(count)[:, None]
    for _ in range(rounds):
        closest = np.argmax(x @ centres.T, axis=1)
        for c in range(side):
            if (closest == c).any():
                centres[c] = (x * weight)[closest == c].sum(axis=0)
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)
    liking = x @ centres.T
    classes, places = np.argmax(liking, axis=1), np.full(len(x), side - 1)
    taken = np.zeros(side, dtype=np.int64)
    for i in range(own):
        c = int(np.argmax(np.where(taken < side - 1, liking[i], -np.inf)))
        classes[i], places[i] = c, taken[c]
        taken[c] += 1
    return classes, places


def row_sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, number of each, sum of its values); key i stands for row i of values, which repeat.

    Most keys stand once or a few times, so sums are built up by the keys' second rows, third
    ones and so on; the few with many rows are summed up one by one.
    """
    order = np.argsort(keys)
    keys, at = keys[order], order % len(values)
    new = np.concatenate(([True], keys[1:] != keys[:-1]))
    first = np.flatnonzero(new)
    number = np.diff(np.append(first, len(keys)))
    out = values.take(at[first], axis=0)
    many = np.flatnonzero(number > 32)
    segment = np.cumsum(new) - 1
    nth = np.arange(len(keys)) - first[segment]
    left = np.flatnonzero((nth > 0) & (number[segment] <= 32))
    n = 1
    while len(left):
        now = nth[left] == n
        rows, left = left[now], left[~now]
        out[segment[rows]] += values.take(at[rows], axis=0)
        n += 1
    for i in many:
        out[i] = values.take(at[first[i] : first[i] + number[i]], axis=0).sum(axis=0)
    return keys[first], number, out


def steps(weights: np.ndarray, scale: np.ndarray, seen: np.ndarray, rows: list[np.ndarray], gradient: np.ndarray, rate: float) -> None:
    """One update of the rows active in a batch; a row's steps shrink with the gradients it has had."""
    f, number, total = row_sums(np.concatenate(rows), gradient)
    seen[f] += number
    scale[f] += np.einsum("ij,ij->i", total, total) / total.shape[1]
    total *= (rate / np.sqrt(scale[f]))[:, None]
    weights[f] -= total


def train_on(m: LanguageModel, slices: Iterator[Words], rate: float) -> tuple[np.ndarray, np.ndarray]:
    """Goes through the slices once and changes the weights of m; how often each feature was active."""
    units = len(m.unit_class)
    tables = (m.by_class, m.by_place)
    scale = [np.full(len(t), 1e-6, dtype=np.float32) for t in tables]
    seen = [np.zeros(len(t)) for t in tables]
    room = Room(m.by_class.shape[1])
    for w in slices:
        h, s, _, bound = tokens_of(w)
        u = m.units(h, s)
        before = contexts(u, bound, units)
        c, p = m.unit_class[u], m.unit_place[u]
        for k, (rows, aim) in enumerate(((features(before, units), c), (place_features(before, c, units), p))):
            for a in range(0, len(u), BATCH):
                some = [r[a : a + BATCH] for r in rows]
                z = room.gradient(tables[k], some, k == 0, aim[a : a + BATCH])
                steps(tables[k], scale[k], seen[k], some, z, rate)
    return seen[0], seen[1]


def _trained(model, rate: float) -> Callable:
    """(row, values): the change of each feature's weights times how often it was active, and that number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        old = m.by_class, m.by_place
        mine = replace(m, by_class=old[0].copy(), by_place=old[1].copy())
        seen = train_on(mine, (w for batch in batches for w in word_slices(batch.column(0), SPACED)), rate)
        base = 0
        for before, after, n in zip(old, (mine.by_class, mine.by_place), seen, strict=True):
            some = np.flatnonzero(n)
            for a in range(0, len(some), 4096):
                rows = some[a : a + 4096]
                values = np.concatenate(((after[rows] - before[rows]) * n[rows, None], n[rows, None]), axis=1).astype(np.float32)
                yield pa.RecordBatch.from_arrays([pa.array(rows + base, pa.int32()), pa.array([x.tobytes() for x in values], pa.binary())], ["row", "values"])
            base += len(before)

    return run


def log10_probabilities(m: LanguageModel, units: np.ndarray, bound: np.ndarray, room: Room) -> np.ndarray:
    """log10 of each token's probability; of a word without a place of its own, times its count + 1, still unknown."""
    n = len(m.unit_class)
    before = contexts(units, bound, n)
    c, p = m.unit_class[units], m.unit_place[units]
    out = np.empty(len(units))
    for a in range(0, len(units), BATCH):
        e = slice(a, a + BATCH)
        some = [b[e] for b in before]
        out[e] = room.log_probability(m.by_class, features(some, n), True, c[e])
        out[e] += room.log_probability(m.by_place, place_features(some, c[e], n), False, p[e])
    return out / np.log(10) - np.where(units >= len(m.own), m.rest[c], 0.0)


def _score(model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        room = Room(m.by_class.shape[1])
        rid = TaskContext.get().partitionId() << 33
        for batch in batches:
            for w in word_slices(batch.column(2), SPACED):
                h, s, row, bound = tokens_of(w)
                u = m.units(h, s)
                placed = u < len(m.own)
                own = log10_probabilities(m, u, bound, room)
                own[placed] -= m.own_log[u[placed]]
                rows = w.rows
                hit = np.zeros(len(h), dtype=bool)
                value = np.zeros(len(h))
                if len(m.frequent):
                    at, hit = m.frequent_at(h)
                    value[hit] = m.frequent_log[at[hit]]
                words, counts = [], []
                rare = np.flatnonzero(~hit)
                cut = np.searchsorted(row[rare], np.arange(rows + 1))
                for r in range(rows):
                    u, n = np.unique(h[rare[cut[r] : cut[r + 1]]], return_counts=True)
                    words.append(u)
                    counts.append(n)
                ends = np.cumsum([0, *map(len, words)])
                flat = lambda x, kind: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(x) if x else [], kind))
                part = batch.slice(w.first, rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(rid, rid + rows)), part.column(0), part.column(1), pa.array(np.diff(bound), pa.int64()),
                        pa.array(np.bincount(row, weights=hit, minlength=rows).astype(np.int64)), pa.array(np.bincount(row, weights=value, minlength=rows)),
                        pa.array(np.bincount(row, weights=own, minlength=rows)), flat(words, pa.int64()), flat(counts, pa.int64()),
                    ],
                    ["rid", "doc_id", "held_out", "n_tokens", "known", "logs", "own", "words", "counts"],
                )
                rid += rows

    return run


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(False))


def fit(training: DataFrame, rounds: int = ROUNDS) -> tuple[LanguageModel, DataFrame, int, int, int]:
    """A model of the rows (text), the words' counts (word, suffix, n), the least count of a frequent word, tokens and types."""
    spark = training.sparkSession
    counts = training.mapInArrow(_word_counts, "word long, suffix int, n long").groupBy("word").agg(F.first("suffix").alias("suffix"), F.sum("n").alias("n"))
    counts = written(counts, "lm-counts")
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # The least count of a frequent word, from the number of words with each count.
    by_count = counts.groupBy("n").agg(F.count("*").alias("words")).toPandas().sort_values("n", ascending=False)
    fits = by_count[by_count["words"].cumsum() <= FREQUENT]
    least = int(fits["n"].min()) if len(fits) else 1 << 62
    frequent = counts.filter(F.col("n") >= least).select("word", "n").toPandas().sort_values("word")
    words = counts.filter(F.col("word") != int(END))
    top = words.orderBy(F.desc("n"), "word").select("word", "n", "suffix").limit(SIDE * (SIDE - 1) - 1).toPandas()
    ends = counts.filter(F.col("word") == int(END)).select("n").first()
    own = np.concatenate(([END], top["word"].to_numpy(dtype=np.int64)))
    own_count = np.concatenate(([ends.n if ends else 0], top["n"].to_numpy(dtype=np.int64)))
    order = np.argsort(own)
    left = np.zeros(SUFFIXES)  # counts + 1 of the words without places, by suffix
    for r in words.groupBy("suffix").agg(F.sum(F.col("n") + 1).alias("n")).collect():
        left[r.suffix] = r.n
    np.subtract.at(left, top["suffix"].to_numpy(dtype=np.int64), top["n"].to_numpy(dtype=np.int64) + 1)

    units = len(own) + SUFFIXES
    none = np.zeros(0)
    model = LanguageModel(own[order], order, np.log10(own_count + 1.0), np.zeros(units, np.int64), np.zeros(units, np.int64), none, frequent["word"].to_numpy(dtype=np.int64), np.log10(frequent["n"].to_numpy(dtype=np.float64) + 1), none, none)
    near = training.mapInArrow(_neighbours(spark.sparkContext.broadcast(model)), "row int, values binary")
    model.unit_class, model.unit_place = word_classes(_summed(near, units, 2 * NEIGHBOURS), len(own))
    classes, places = model.unit_class, model.unit_place
    count = np.concatenate((own_count + 1.0, left))
    rest = np.bincount(classes[len(own) :], weights=left, minlength=SIDE) + 1
    model.rest = np.log10(rest)
    share = np.zeros((SIDE, SIDE))
    np.add.at(share, (classes, places), count)
    share[np.unique(classes[len(own) :]), SIDE - 1] += 1  # the words never seen
    with np.errstate(divide="ignore", invalid="ignore"):
        model.by_place = np.full((SIDE + WITHIN, SIDE), 0, dtype=np.float32)
        model.by_place[:SIDE] = np.where(share > 0, np.log(share / share.sum(axis=1, keepdims=True)), _ABSENT)
        model.by_class = np.zeros((n_features(units), SIDE), dtype=np.float32)
        model.by_class[0] = np.where(share.sum(axis=1) > 0, np.log(share.sum(axis=1) / share.sum()), _ABSENT)

    # A trainer reads a few of the input's partitions.
    parts = training.rdd.getNumPartitions()
    cores = spark.sparkContext.defaultParallelism
    number, unit = re.match(r"(\d+)\s*([kmg]?)", spark.conf.get("spark.sql.files.maxPartitionBytes").lower()).groups()
    each = max(1, TRAINER_BYTES // (int(number) << {"": 0, "k": 10, "m": 20, "g": 30}[unit]))
    trainers = max(1, min(parts, max(cores, parts // each)))
    for r in range(rounds):
        shared = spark.sparkContext.broadcast(model)
        part = training.filter(F.pmod(F.coalesce(F.xxhash64("text"), F.lit(0)), F.lit(rounds)) == r)
        change = part.coalesce(trainers).mapInArrow(_trained(shared, RATE / (1 + r)), "row int, values binary")
        total = _summed(change, len(model.by_class) + len(model.by_place), SIDE + 1)
        step = (total[:, :SIDE] / np.maximum(total[:, SIDE:], 1)).astype(np.float32)
        model = replace(model, by_class=model.by_class + step[: len(model.by_class)], by_place=model.by_place + step[len(model.by_class) :])
        shared.unpersist()
    return model, counts, least, int(totals[0]), int(totals[1])


def lm_scores(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words of the whole text, A-Z lower-cased, and one end. The model learns
    from the rows whose crc32(doc_id as text) mod 7 is not 2; a null id is one of them. Null
    and empty texts hold the end alone. Both scores are log10 probabilities of the text; over
    all words with places, all other known words, and one word never seen in each class that
    takes such words, a token's probabilities add up to 1. With nothing to learn from, the
    end and the words never seen are left. Repeated rows count and are scored each. An empty
    table gives an empty one; other columns play no part.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    model, counts, least, tokens, types = fit(docs.filter(~F.col("held_out")).select("text"), rounds)
    shared = spark.sparkContext.broadcast(model)

    kind = f"rid long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, n_tokens long, known long, logs double, own double, words array<long>, counts array<long>"
    scored = written(docs.mapInArrow(_score(shared), kind), "lm-scores")
    rare = scored.select("rid", F.explode(F.arrays_zip("words", "counts")).alias("x")).select("rid", F.col("x.words").alias("w"), F.col("x.counts").alias("tf"))
    known = counts.filter(F.col("n") < least).select("word", "n")
    joined = rare.join(known, F.col("w") == F.col("word"))  # words without a count add log10(1)
    more = joined.groupBy("rid").agg(F.sum(F.col("tf") * F.log10(F.col("n") + 1)).alias("l"), F.sum("tf").alias("k")).withColumnRenamed("rid", "r")
    out = scored.drop("words", "counts").join(more, F.col("rid") == F.col("r"), "left")
    logs = F.col("logs") + F.coalesce("l", F.lit(0.0))
    base = logs - F.col("n_tokens") * F.lit(float(np.log10(tokens + types + 1)))
    return out.select("doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("k", F.lit(0))).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"), base.alias("base_score"), (logs + F.col("own")).alias("score"))


def op6_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op6_maxent_lm": op6_maxent_lm}
ORACLE: dict[str, str] = {}
