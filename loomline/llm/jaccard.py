"""N-gram Jaccard join with a token-group matrix.

Documents are sets of shingles. Equal sets are one. The shingles have a global order,
rare before frequent; two sets that link share one of their first ones, so only those
enter the matrix. Similar sets are put into groups: sets that share a first shingle are
compared with the best of them and the linked ones stand together; those that linked with
none stand together by the most frequent of their first shingles. The matrix says, for
each first shingle, which groups hold it, and a set queries the groups that hold one of
its own. Of every group so asked the token union is stored, as a bitmap of hashed tokens,
with the size of its smallest member. The number of a query's tokens in the union bounds
what it can share with any member; only the groups that some query may reach are opened,
their texts moved, and compared in full with those queries.

Frequencies come from a sketch of fixed width over all documents. They decide the order,
hence the work, but not the result: any order that all sets share gives the same links.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomline.llm.components import connected
from loomline.llm.shared import small, written
from loomline.llm.words import SPACED, mix, shingle_hashes, word_slices

SKETCH_BITS = 21
CHUNK_BITS = 16
SALTS = 16
#: Sets in a group of the matrix, about, and shingles of them all.
GROUP = 64
GROUP_SHINGLES = 1 << 21
#: Queries that meet one copy of a group, about.
QUERIES_A_GROUP = 256
#: Cells and asking sets of one shingle that meet in one place.
CELLS_A_PLACE = 64
ASKS_A_PLACE = 8192
#: A shingle whose cell of the sketch counts this many times the mean is hot, and so many places hold its list.
HOT = 64
HOT_PLACES = 1024
#: Times that groups are extended by other leads, at most; what is left is the matrix's.
TURNS = 4
_U = np.uint64


def set_slices(column: pa.Array, k: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sorted distinct shingle hashes of each row) of runs of rows."""
    for w in word_slices(column, SPACED):
        hashes, at = shingle_hashes(w, k)
        bound = np.searchsorted(w.row[at], np.arange(w.rows + 1))
        yield w.first, [np.unique(hashes[bound[r] : bound[r + 1]]) for r in range(w.rows)]


def _profile(k: int) -> Callable:
    """Rows (doc_id, n, h1, h2) for documents and (chunk, salt, counts) for the task's sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        waiting: list[np.ndarray] = []

        def add() -> None:
            if waiting:
                np.add(counts, np.bincount((np.concatenate(waiting) >> _U(64 - SKETCH_BITS)).astype(np.int64), minlength=len(counts)), out=counts)
                waiting.clear()

        for batch in batches:
            n, one, two = [], [], []
            for _, sets in set_slices(batch.column(1), k):
                for s in sets:
                    n.append(len(s))
                    one.append(int(np.sum(mix(s), dtype=np.uint64).astype(np.int64)))
                    two.append(int(np.sum(mix(s ^ _U(0x5851F42D4C957F2D)), dtype=np.uint64).astype(np.int64)))
                waiting += sets
                if sum(map(len, waiting)) > 1 << 20:
                    add()
            none = pa.nulls(len(n), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), none, none, pa.nulls(len(n), pa.binary())], ["doc_id", "n", "h1", "h2", "chunk", "salt", "counts"])
        add()
        size = 1 << CHUNK_BITS
        salt = TaskContext.get().partitionId() % SALTS
        for c in range(len(counts) // size):
            part = counts[c * size : (c + 1) * size]
            if part.any():
                packed = np.minimum(part, 65535).astype(np.uint16).tobytes()
                yield pa.RecordBatch.from_arrays([*(pa.nulls(1, pa.int64()) for _ in range(4)), pa.array([c], pa.int32()), pa.array([salt], pa.int32()), pa.array([packed], pa.binary())], ["doc_id", "n", "h1", "h2", "chunk", "salt", "counts"])

    return run


def _add_up(kind: type, last: bool) -> Callable:
    """Sums chunks as they stream by; the last step turns counts into 8 bits of their logarithm."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for c, s, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                part = np.frombuffer(x.as_buffer(), dtype=kind).astype(np.int64)
                key = (c, 0 if last else s)
                sums[key] = sums[key] + part if key in sums else part
        for (c, s), x in sums.items():
            packed = np.minimum(np.log2(1 + x) * 6, 255).astype(np.uint8) if last else x
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([s], pa.int32()), pa.array([packed.tobytes()], pa.binary())], ["chunk", "salt", "counts"])

    return run


def _sketch(profile: DataFrame) -> np.ndarray:
    """The sketch of the whole corpus: 2**SKETCH_BITS bytes, whatever its size."""
    kind = "chunk int, salt int, counts binary"
    chunks = profile.filter("chunk is not null").select("chunk", "salt", "counts")
    chunks = chunks.repartition("chunk", "salt").mapInArrow(_add_up(np.uint16, False), kind)
    chunks = chunks.repartition("chunk").mapInArrow(_add_up(np.int64, True), kind)
    out = np.zeros(1 << SKETCH_BITS, dtype=np.uint8)
    for c, counts in chunks.select("chunk", "counts").collect():
        out[c << CHUNK_BITS : (c + 1) << CHUNK_BITS] = np.frombuffer(counts, dtype=np.uint8)
    return out


def _first_shingles(k: int, num: int, den: int, sketch) -> Callable:
    """(id, n, first): the first shingles in the order, and the set's size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = sketch.value
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, sets in set_slices(batch.column(1), k):
                out_id, size, firsts = [], [], []
                for r, s in enumerate(sets):
                    n = len(s)
                    if n:
                        seen = level[(s >> _U(64 - SKETCH_BITS)).astype(np.int64)]
                        key = (seen.astype(np.uint64) << _U(56)) | (mix(s) >> _U(8))
                        p = n - (num * n + den - 1) // den + 1
                        out_id.append(ids[first + r])
                        size.append(n)
                        firsts.append(np.partition(key, p - 1)[:p].astype(np.int64))
                sizes = np.cumsum([0, *map(len, firsts)])
                tokens = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.concatenate(firsts) if firsts else [], pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(out_id, pa.int64()), pa.array(size, pa.int64()), tokens], ["id", "n", "first"])

    return run


def _common(x: np.ndarray, y: np.ndarray) -> int:
    if len(x) > len(y):
        x, y = y, x
    if not len(x):
        return 0
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int(np.count_nonzero(y[at] == x))


def _unions(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """(g, least, union) from rows (g, text) in order of g: a bitmap of the tokens, 8 to 16 bits for each, and the smallest size."""
    here, sets = None, []

    def stored() -> pa.RecordBatch:
        tokens = np.unique(np.concatenate(sets))
        bits = max(6, int(8 * len(tokens) - 1).bit_length())
        marks = np.zeros(1 << bits, dtype=bool)
        marks[(tokens >> _U(64 - bits)).astype(np.int64)] = True
        return pa.RecordBatch.from_arrays([pa.array([here], pa.int64()), pa.array([min(map(len, sets))], pa.int64()), pa.array([np.packbits(marks).tobytes()], pa.binary())], ["g", "least", "union"])

    for batch in batches:
        groups = batch.column(0).to_pylist()
        for first, part in set_slices(batch.column(1), k):
            for i, s in enumerate(part, first):
                if groups[i] != here and sets:
                    yield stored()
                    sets = []
                here = groups[i]
                sets.append(s)
    if sets:
        yield stored()


def _bounded(k: int, num: int, den: int) -> Callable:
    """(g, id) of the queries that may link, from rows (g, salt, asks, id, text, least, union) in which a group's union comes first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, bits, least = np.zeros(1, bool), 0, 0
        for batch in batches:
            groups, asks, doc, sizes = (batch.column(i).to_pylist() for i in (0, 2, 3, 5))
            out_g, out_id = [], []
            for first, part in set_slices(batch.column(4), k):
                for i, s in enumerate(part, first):
                    if not asks[i]:
                        marks = np.unpackbits(np.frombuffer(batch.column(6)[i].as_buffer(), dtype=np.uint8)).view(bool)
                        bits, least = len(marks).bit_length() - 1, sizes[i]
                        continue
                    both = int(np.count_nonzero(marks[(s >> _U(64 - bits)).astype(np.int64)]))
                    # |both| >= t / (1 + t) * (|q| + |s|), where |s| >= t * |q| and no member is smaller than the least.
                    if (num + den) * both >= num * (len(s) + max(least, -(-num * len(s) // den))):
                        out_g.append(groups[i])
                        out_id.append(doc[i])
            yield pa.RecordBatch.from_arrays([pa.array(out_g, pa.int64()), pa.array(out_id, pa.int64())], ["g", "id"])

    return run


def _opened(k: int, num: int, den: int) -> Callable:
    """(a, b) that link, from rows (g, salt, asks, id, text) in which a group's members precede its queries.

    Memory holds the sets of one group.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, ids, sets = None, [], []
        for batch in batches:
            groups, salts, asks, doc = (batch.column(i).to_pylist() for i in range(4))
            out = []
            for first, part in set_slices(batch.column(4), k):
                for i, s in enumerate(part, first):
                    if (groups[i], salts[i]) != here:
                        here, ids, sets = (groups[i], salts[i]), [], []
                    if not asks[i]:
                        ids.append(doc[i])
                        sets.append(s)
                        continue
                    for m, t in zip(ids, sets, strict=True):
                        if m != doc[i] and den * min(len(s), len(t)) >= num * max(len(s), len(t)):
                            both = _common(s, t)
                            if den * both >= num * (len(s) + len(t) - both):
                                out.append((min(m, doc[i]), max(m, doc[i])))
            yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in out], pa.int64()) for j in range(2)], ["a", "b"])

    return run


class _Join:
    """The tables of one join: thin (a row per document), classes of equal sets and lists of first shingles."""

    def __init__(self, docs: DataFrame, k: int, num: int, den: int):
        spark = docs.sparkSession
        self.k, self.num, self.den = k, num, den
        self.docs = docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        profile = written(docs.mapInArrow(_profile(k), "doc_id long, n long, h1 long, h2 long, chunk int, salt int, counts binary"), "join-profile")
        self.thin = profile.filter("chunk is null").select("doc_id", "n", "h1", "h2")
        self.linked = self.thin.filter("n > 0 and doc_id is not null")
        # Equal sets are one node, the smallest id.
        self.classes = written(self.linked.groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("rep")), "join-classes")
        reps = small(self.classes.select(F.col("rep").alias("doc_id")).distinct())
        sketch = _sketch(profile)
        shingles = _first_shingles(k, num, den, spark.sparkContext.broadcast(sketch))
        first = docs.join(reps, "doc_id", "left_semi").mapInArrow(shingles, "id long, n long, first array<long>")
        # Shingles that only one set has go. A hot one, which the sketch tells by its first
        # byte, is taken to be shared, so that its list need not lie in one place.
        mean = float(np.mean(2.0 ** (sketch / 6.0)) - 1)
        hot = F.shiftrightunsigned(F.col("token"), 56) >= int(min(255, np.log2(1 + HOT * max(mean, 1.0)) * 6))
        place = F.when(hot, F.pmod(F.xxhash64("id"), F.lit(HOT_PLACES))).otherwise(F.lit(0))
        same = Window.partitionBy("token", "place")
        lists = first.select(F.explode("first").alias("token"), "id", "n").withColumn("place", place)
        lists = lists.withColumn("alone", ~hot & (F.min("id").over(same) == F.max("id").over(same)))
        self.lists = written(lists.filter(~F.col("alone")).select("token", "id", "n"), "join-lists")

    def several_classes(self) -> DataFrame | None:
        """Edges (a, b) from a class's node to each id with rows in other classes, or without shingles, too; None if no id has."""
        key = F.struct("h1", "h2", "n")
        ids = self.thin.filter("doc_id is not null").groupBy("doc_id").agg(F.min(key).alias("lo"), F.max(key).alias("hi")).filter("lo <> hi").select("doc_id")
        ids = written(ids, "join-repeated")
        if ids.isEmpty():
            return None
        return written(self.linked.join(small(ids), "doc_id").join(self.classes, ["h1", "h2", "n"]).select(F.col("rep").alias("a"), F.col("doc_id").alias("b")), "join-repeats")

    def near(self, a: str, b: str):
        return (F.col(a) * self.den >= F.col(b) * self.num) & (F.col(b) * self.den >= F.col(a) * self.num)

    def shares(self, queries: DataFrame) -> DataFrame:
        """(g, salts): in how many places a group of so many queries meets them."""
        return written(queries.groupBy("g").agg(F.ceil(F.count("*") / QUERIES_A_GROUP).cast("int").alias("salts")), "join-salts")

    def compared(self, members: DataFrame, queries: DataFrame) -> DataFrame:
        """Links of the queries (g, id) with the members (g, id) of their groups. Texts move, as they are smaller than their sets."""
        split = small(self.shares(queries))
        ask = queries.join(split, "g").select("g", F.pmod(F.xxhash64("id"), "salts").cast("int").alias("salt"), F.lit(True).alias("asks"), "id")
        told = members.join(split, "g").select("g", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(False).alias("asks"), "id")
        rows = small(written(ask.union(told), "join-rows"))
        texts = self.docs.join(rows, F.col("doc_id") == F.col("id")).select("g", "salt", "asks", "id", "text")
        texts = texts.repartition("g", "salt").sortWithinPartitions("g", "salt", "asks")
        return written(texts.mapInArrow(_opened(self.k, self.num, self.den), "a long, b long").distinct(), "join-links")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that link; the end with more pairs is the group that the other asks."""
        degree = pairs.select(F.col("a").alias("e")).union(pairs.select("b")).groupBy("e").agg(F.count("*").alias("pairs"))
        degree = small(written(degree, "join-degrees"))
        both = pairs.join(degree.toDF("a", "pa"), "a").join(degree.toDF("b", "pb"), "b")
        hub = F.col("pa") >= F.col("pb")
        both = written(both.select(F.when(hub, F.col("a")).otherwise(F.col("b")).alias("g"), F.when(hub, F.col("b")).otherwise(F.col("a")).alias("id")), "join-stars")
        return self.compared(both.select("g", F.col("g").alias("id")).distinct(), both)

    def led(self, rows: DataFrame, rank: str, grown: bool) -> DataFrame:
        """Pairs of each set with the highest ranked of its lists, smaller id first.

        Lists within one component are left out and, with grown, those without a component.
        The best of each list is joined to it, and a join can split a long list.
        """
        size = F.count("size") if grown else F.lit(1)
        tops = rows.groupBy("token").agg(F.max(F.struct(rank, "id", "n", "c")).alias("top"), F.min("c").alias("lo"), F.max("c").alias("hi"), size.alias("some"))
        tops = tops.filter("lo <> hi and some > 0").select("token", F.col("top.id").alias("lead"), F.col("top.n").alias("lead_n"), F.col("top.c").alias("lead_c"))
        pairs = rows.select("token", "id", "n", "c").join(tops, "token")
        pairs = pairs.filter((F.col("c") != F.col("lead_c")) & self.near("n", "lead_n"))
        return pairs.select(F.least("id", "lead").alias("a"), F.greatest("id", "lead").alias("b")).distinct()

    def reachable(self, sets: DataFrame, meets: DataFrame) -> DataFrame:
        """The (g, id) of meets whose set may link with a member of g, by the stored unions of the groups (id, g) asked."""
        asked = small(written(meets.select("g").distinct(), "join-asked"))
        members = small(written(sets.select("g", "id").join(asked, "g", "left_semi"), "join-members"))
        texts = self.docs.join(members, F.col("doc_id") == F.col("id")).select("g", "text").repartition("g").sortWithinPartitions("g")
        k = self.k
        unions = written(texts.mapInArrow(lambda batches: _unions(batches, k), "g long, least long, union binary"), "join-unions")
        split = small(self.shares(meets))
        stored = unions.join(split, "g").select("g", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(False).alias("asks"), F.lit(None).cast("long").alias("id"), F.lit(None).cast("string").alias("text"), "least", "union")
        ask = small(written(meets.join(split, "g").select("g", F.pmod(F.xxhash64("id"), "salts").cast("int").alias("salt"), "id"), "join-asking"))
        ask = self.docs.join(ask, F.col("doc_id") == F.col("id")).select("g", "salt", F.lit(True).alias("asks"), "id", "text", F.lit(None).cast("long").alias("least"), F.lit(None).cast("binary").alias("union"))
        rows = stored.union(ask).repartition("g", "salt").sortWithinPartitions("g", "salt", "asks")
        return written(rows.mapInArrow(_bounded(k, self.num, self.den), "g long, id long").distinct(), "join-reachable")

    def met(self, asks: DataFrame, cells: DataFrame) -> DataFrame:
        """asks and cells by token. A hot token's are dealt over a grid: each block of its cells meets each block of its asks in a place of its own."""
        cells = written(cells, "join-cells")
        shape = cells.groupBy("token").agg(F.ceil(F.count("*") / CELLS_A_PLACE).cast("int").alias("across"), F.ceil(F.sum("held") / ASKS_A_PLACE).cast("int").alias("down"))
        shape = small(written(shape.filter("across > 1 or down > 1"), "join-hot-tokens"))
        across, down = (F.coalesce(c, F.lit(1)) for c in ("across", "down"))
        every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
        asks = asks.join(shape, "token", "left").withColumn("y", F.pmod(F.xxhash64("a"), down).cast("int")).withColumn("x", every(across)).drop("across", "down")
        cells = cells.join(shape, "token", "left").withColumn("x", F.pmod(F.xxhash64("cg"), across).cast("int")).withColumn("y", every(down)).drop("across", "down")
        return asks.join(cells, ["token", "x", "y"])

    def matrix(self, comps: DataFrame | None) -> DataFrame | None:
        """Links (a, b) between sets of different components (id, component), or, without them, of any two sets.

        A set without component stands in a group of such sets, those that share the most
        frequent of its first shingles. Sets of a group are alike in size, which keeps the
        bound close.
        """
        num, den = self.num, self.den
        if comps is None:
            rows = self.lists.withColumn("component", F.lit(None).cast("long")).withColumn("size", F.lit(1).cast("long")).withColumn("c", F.col("id"))
        else:
            sizes = comps.groupBy("component").agg(F.count("*").alias("size"))
            of = comps.join(sizes, "component").select(F.col("id").alias("mid"), "component", "size")
            rows = self.lists.join(of, F.col("id") == F.col("mid"), "left").withColumn("c", F.coalesce("component", "id"))
        met = rows.groupBy("token").agg(F.count("*").alias("met"), F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo <> hi").select("token", "met")
        rows = rows.join(met, "token")
        rows = written(rows.select("token", "id", "n", "component", F.coalesce("size", F.lit(1)).alias("size"), "met"), "join-matrix")
        sets = rows.groupBy("id").agg(F.first("n").alias("n"), F.first("component").alias("component"), F.max(F.struct("met", "token")).alias("top"))
        sets = sets.withColumn("kin", F.coalesce("component", "top.token")).withColumn("band", F.floor(F.log(F.col("n").cast("double")) * 20))
        sets = sets.withColumn("single", F.col("component").isNull()).drop("top")
        sets = written(sets, "join-sets")
        alike = sets.groupBy("single", "kin", "band").agg(F.ceil(F.greatest(F.count("*") / GROUP, F.sum("n") / GROUP_SHINGLES)).alias("chunks"))
        # A group of one chunk, as nearly all are, needs no number; the others are few.
        split = small(written(alike.filter("chunks > 1"), "join-chunks"))
        sets = sets.join(split, ["single", "kin", "band"], "left")
        sets = sets.withColumn("g", F.xxhash64("single", "kin", "band", F.pmod(F.xxhash64("id"), F.coalesce("chunks", F.lit(1)))))
        sets = written(sets.select("id", F.coalesce("component", "g").alias("c"), "g"), "join-groups")

        asks = rows.select("token", F.col("id").alias("a"), "n", "size").join(sets.withColumnRenamed("id", "a"), "a")
        cells = asks.groupBy("token", F.col("g").alias("cg"), F.col("c").alias("gc"), F.col("size").alias("gsize")).agg(F.min("n").alias("least"), F.max("n").alias("most"), F.count("*").alias("held"))
        # The smaller component asks, so a large one is met by groups and not by rows. Groups
        # of single sets ask in order and also within themselves.
        turn = F.struct("size", "c") < F.struct(F.col("gsize").alias("size"), F.col("gc").alias("c"))
        meets = self.met(asks, cells).filter(turn | ((F.col("size") == 1) & (F.col("g") == F.col("cg")) & (F.col("held") > 1)))
        meets = meets.filter((F.col("n") * den >= F.col("least") * num) & (F.col("most") * den >= F.col("n") * num))
        meets = written(meets.select(F.col("cg").alias("g"), F.col("a").alias("id")).distinct(), "join-meets")
        if meets.isEmpty():
            return None
        reach = self.reachable(sets, meets)
        if reach.isEmpty():
            return None
        opened = small(written(reach.select("g").distinct(), "join-opened"))
        return self.compared(sets.select("g", "id").join(opened, "g", "left_semi"), reach)


def jaccard_links(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """All links (a, b), a < b, between the representatives of different sets, which are the smallest ids that hold them.

    Which documents hold which set follows from `set_members`. The terms, and what counts
    for null, empty and repeated rows, are those of `jaccard_components`. Their number may
    be quadratic in a group of near copies, as every pair of it is a link.
    """
    links = _Join(docs, k, num, den).matrix(None)
    return docs.sparkSession.createDataFrame([], "a long, b long") if links is None else links


def set_members(docs: DataFrame, k: int = 5) -> DataFrame:
    """(doc_id, n_shingles, rep): rep is the smallest id with an equal, non-empty set; null where the set or id is null or empty."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    thin = docs.mapInArrow(_profile(k), "doc_id long, n long, h1 long, h2 long, chunk int, salt int, counts binary").filter("chunk is null")
    thin = written(thin.select("doc_id", "n", "h1", "h2"), "join-thin")
    reps = thin.filter("n > 0 and doc_id is not null").groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("rep"))
    out = thin.join(reps, ["h1", "h2", "n"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.col("rep")).alias("rep"))


def jaccard_components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_shingles, component_id.

    Two documents link when den * |both| >= num * |either| over their distinct shingles of
    k words; a text of fewer words, but not none, is one shingle. component_id is the
    smallest doc_id reachable by links, itself included. Null, empty and blank texts have
    no shingles and link with nothing. Rows with a null id link with nothing and get a null
    component; rows that share an id are one node, which links by any of its texts. Equal
    texts link. An empty table gives an empty one. Other columns play no part. Shingles are
    compared by 64-bit hashes.
    """
    join = _Join(docs, k, num, den)
    lists = join.lists
    # Groups form around leads: first the set of each list whose first shingles are shared
    # the most, as those of an original are by its copies; then others, drawn by hash, for
    # the sets that linked with no lead so far.
    share = lists.groupBy(F.col("id").alias("i")).agg((F.count("*") / (F.first("n") - F.ceil(F.first("n") * num / den) + 1)).alias("share"))
    done = written(join.led(lists.join(share, F.col("id") == F.col("i")).withColumn("c", F.col("id")), "share", False), "join-stars")
    links, repeats = join.verified(done), join.several_classes()
    if repeats is not None:
        links = links.union(repeats)
    comps = connected(links)
    for turn in range(1, TURNS):
        size = comps.groupBy("component").agg(F.count("*").alias("size"))
        of = comps.join(size, "component").select(F.col("id").alias("mid"), F.col("component").alias("mc"), "size")
        rows = lists.join(of, F.col("id") == F.col("mid"), "left").select("token", "id", "n", F.coalesce("mc", "id").alias("c"), "size")
        rows = rows.withColumn("rank", F.struct(F.col("size").isNotNull().alias("grown"), F.xxhash64("id", F.lit(turn)).alias("draw")))
        pairs = written(join.led(rows, "rank", True).join(done, ["a", "b"], "left_anti"), "join-stars")
        if pairs.isEmpty():
            break
        done = done.union(pairs)
        found = join.verified(pairs)
        if found.isEmpty():
            break
        links = links.union(found)
        comps = connected(links)
    more = join.matrix(comps)
    if more is not None:
        comps = connected(links.union(more))

    named = join.classes.join(comps.withColumnRenamed("id", "rep"), "rep", "left").select("h1", "h2", "n", F.coalesce("component", "rep").alias("component_id"))
    out = join.thin.join(named, ["h1", "h2", "n"], "left")
    if repeats is not None:  # rows without shingles belong to their id's node
        of = comps.join(small(written(repeats.select(F.col("b").alias("id")).distinct(), "join-repeated")), "id", "left_semi").toDF("_id", "_component")
        out = out.join(of, (F.col("n") == 0) & (F.col("doc_id") == F.col("_id")), "left").withColumn("component_id", F.coalesce("component_id", "_component"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def keep_one(docs: DataFrame, **how) -> DataFrame:
    """docs with one row of each component, that of the smallest id; all columns stay.

    Of rows that share the kept id, any one stays. Rows with a null id all stay.
    """
    kept = written(jaccard_components(docs, **how).filter("doc_id = component_id").groupBy(F.col("doc_id").alias("_id")).agg(F.count("*").alias("_rows")), "join-kept")
    one = small(kept.filter("_rows = 1").select("_id"))
    out = docs.join(one, docs["doc_id"] == one["_id"], "left_semi").union(docs.filter(docs["doc_id"].isNull()))
    several = small(kept.filter("_rows > 1").select("_id"))
    if not several.isEmpty():
        out = out.union(docs.join(several, docs["doc_id"] == several["_id"], "left_semi").dropDuplicates(["doc_id"]))
    return out


def op1_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def components_sql(table: str = "documents", k: int = 5, num: int = 80, den: int = 100) -> str:
    """DuckDB SQL that compares all pairs which share a shingle."""
    slices = f"CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {k} THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - {k - 2}), lambda i: array_to_string(w[i:i + {k - 1}], ' '))) END"
    return f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM {table}
), sets AS (
  SELECT doc_id, {slices} AS s FROM words
), reps AS (
  SELECT s, rep, row_number() OVER () AS c
  FROM (SELECT list_sort(s) AS s, min(doc_id) AS rep FROM sets WHERE len(s) > 0 AND doc_id IS NOT NULL GROUP BY 1)
), tokens AS (
  SELECT rep, c, len(s) AS n, unnest(s) AS t FROM reps
), links AS (
  SELECT a.rep AS a, b.rep AS b
  FROM tokens a JOIN tokens b ON a.t = b.t AND a.c < b.c AND a.rep <> b.rep AND {den} * a.n >= {num} * b.n AND {den} * b.n >= {num} * a.n
  GROUP BY a.rep, b.rep, a.c, b.c, a.n, b.n
  HAVING {den} * count(*) >= {num} * (a.n + b.n - count(*))
), repeats AS (
  SELECT DISTINCT r.rep AS a, d.doc_id AS b FROM sets d JOIN reps r ON list_sort(d.s) = r.s
  WHERE d.doc_id IN (SELECT doc_id FROM sets GROUP BY doc_id HAVING count(*) > 1) AND r.rep <> d.doc_id
), pairs AS (
  SELECT * FROM links UNION ALL SELECT * FROM repeats
), edges AS (
  SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), reach(v, u) AS (
  SELECT a, a FROM (SELECT DISTINCT a FROM edges)
  UNION
  SELECT r.v, e.b FROM reach r JOIN edges e ON r.u = e.a
), comps AS (
  SELECT v, min(u) AS c FROM reach GROUP BY v
)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles,
       CASE WHEN d.doc_id IS NOT NULL THEN coalesce(c.c, r.rep, d.doc_id) END AS component_id
FROM sets d LEFT JOIN reps r ON len(d.s) > 0 AND list_sort(d.s) = r.s LEFT JOIN comps c ON c.v = coalesce(r.rep, d.doc_id)"""


QUERIES = {"op1_jaccard_components": op1_jaccard_components}
ORACLE = {"op1_jaccard_components": components_sql()}
