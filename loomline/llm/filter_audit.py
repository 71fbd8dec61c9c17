"""What each of five filters removes, alone and in every order, from one CUBE over their flags.

Documents are counted by their five failure flags and part. CUBE over these gives, for every
subset of filters, rows whose selected flags are all false: the survivors of that subset.
What a filter removes after others is the difference of two subsets, joined as pairs.
"""

from __future__ import annotations

from itertools import combinations, permutations
from math import factorial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.llm.shared import written

FILTERS = "ABCDE"
_COUNTS = ("n", "good", "toxic")


def flags(docs: DataFrame, few: int = 100, distinct_percent: int = 80, capital_percent: int = 10) -> DataFrame:
    """(doc_id, part, digest, a, b, c, d) of docs (doc_id, text, lang): what the text alone says."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    rows = rows.select("doc_id", "part", "text", F.size(words).alias("words"), F.size(F.array_distinct(words)).alias("different"))
    return rows.select(
        "doc_id",
        "part",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        (F.col("words") < few).alias("a"),
        (100 * F.col("different") < distinct_percent * F.col("words")).alias("b"),
        (100 * F.regexp_count("text", F.lit("[A-Z]")) > capital_percent * F.length("text")).alias("c"),
        F.col("text").rlike("[#$%&*|]").alias("d"),
    )


def counts(docs: DataFrame, labels: DataFrame, **limits: int) -> DataFrame:
    """(a, b, c, d, e, part, n, good, toxic): documents by flags and part; one row for each of these that occurs."""
    marks = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("labelled")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    # Null ids, which no label can meet, are spread by their texts.
    rows = flags(docs, **limits).withColumn("salt", F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(1 << 20))).otherwise(F.lit(0)))
    rows = rows.join(marks.withColumn("zero", F.lit(0).cast("long")), (F.col("doc_id") == F.col("labelled")) & (F.col("salt") == F.col("zero")), "left")
    rows = rows.withColumns({m: F.coalesce(m, F.lit(0)) for m in ("good", "toxic")})
    # Copies are counted by id first and then summed, which leaves a few rows for each text, however often it occurs.
    text = ("digest", "a", "b", "c", "d", "part", "good", "toxic")
    by_id = rows.groupBy("doc_id", "salt", *text).agg(F.count(F.lit(1)).alias("k"))
    known = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "k"))
    by_text = by_id.groupBy(*text).agg(F.sum("k").alias("n"), F.min(known).alias("first"), F.sum(F.when(F.col("doc_id").isNull(), F.col("k")).otherwise(0)).alias("nameless"))
    least = by_text.groupBy(F.col("digest").alias("of")).agg(F.min("first.doc_id").alias("least"))
    both = by_text.join(least, F.col("digest") == F.col("of"))
    single = F.col("nameless") + F.when(F.col("first.doc_id") == F.col("least"), F.col("first.k")).otherwise(0)
    split = both.select(*text[1:], F.explode(F.array(F.struct(F.lit(False).alias("e"), single.alias("n")), F.struct(F.lit(True).alias("e"), (F.col("n") - single).alias("n")))).alias("x"))
    split = split.select("a", "b", "c", "d", "x.e", "part", "x.n", "good", "toxic").filter("n > 0")
    return split.groupBy("a", "b", "c", "d", "e", "part").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def survivors(counted: DataFrame) -> DataFrame:
    """(part, subset, n, good, toxic): documents that fail no filter of the subset, a sum of 1 for A, 2 for B, and so on; all 32 for each part."""
    columns = [f.lower() for f in FILTERS]
    cube = counted.cube(*columns, "part").agg(*(F.sum(m).alias(m) for m in _COUNTS), *(F.grouping(c).alias(f"all_{c}") for c in (*columns, "part")))
    subset = sum((F.when(F.col(f"all_{c}") == 0, 1 << i).otherwise(0) for i, c in enumerate(columns)), F.lit(0))
    # A flag that is not selected is null here.
    passed = ~F.greatest(*(F.coalesce(c, F.lit(False)) for c in columns))
    return cube.filter("all_part = 0").groupBy("part", subset.alias("subset")).agg(*(F.sum(F.when(passed, F.col(m)).otherwise(0)).cast("long").alias(m) for m in _COUNTS))


def removals(alive: DataFrame) -> DataFrame:
    """(part, filter, before, kept, removed, good_lost, toxic_lost): what a filter takes after each subset of the others."""
    spark = alive.sparkSession
    pairs = [(f, sum(1 << FILTERS.index(x) for x in b)) for f in FILTERS for r in range(len(FILTERS)) for b in combinations(FILTERS.replace(f, ""), r)]
    pairs = [(f, b, b | 1 << FILTERS.index(f)) for f, b in pairs]
    pairs = spark.createDataFrame(pairs, "filter string, before int, after int")
    later = alive.select(F.col("part").alias("p"), F.col("subset").alias("s"), *(F.col(m).alias(f"{m}_after") for m in _COUNTS))
    both = alive.join(F.broadcast(pairs), F.col("subset") == F.col("before")).join(later, (F.col("part") == F.col("p")) & (F.col("after") == F.col("s")))
    return both.select("part", "filter", "before", F.col("n_after").alias("kept"), *((F.col(m) - F.col(f"{m}_after")).alias(name) for m, name in zip(_COUNTS, ("removed", "good_lost", "toxic_lost"), strict=True)))


def audit(docs: DataFrame, labels: DataFrame, **limits: int) -> DataFrame:
    """One row for each part, order of the filters and step, zeros included.

    docs has doc_id, text and lang, labels doc_id, quality and toxic. Null texts are empty,
    null langs the part "". A text with an id is a copy (E) if a smaller id has it too; rows
    without an id are none and make none, and have no labels. Of repeated rows of the
    smallest id none is a copy. A document is good, or toxic, if any label of its id says
    so. An empty table gives no rows; other columns play no part.
    """
    spark = docs.sparkSession
    # 32 rows for each part: read several times below.
    taken = written(removals(written(survivors(counts(docs, labels, **limits)), "audit-survivors")), "audit-removals")
    others = len(FILTERS) - 1
    weights = F.element_at(F.array(*(F.lit(factorial(k) * factorial(others - k)) for k in range(others + 1))), F.bit_count("before") + 1)
    rest = F.lit((1 << len(FILTERS)) - 1) - F.element_at(F.create_map(*(x for i, f in enumerate(FILTERS) for x in (F.lit(f), F.lit(1 << i)))), F.col("filter"))
    each = taken.groupBy(F.col("part").alias("p"), F.col("filter").alias("f")).agg(
        F.sum(F.col("removed") * weights).alias("shapley"),
        F.sum(F.when(F.col("before") == 0, F.col("removed"))).alias("fails"),
        F.sum(F.when(F.col("before") == rest, F.col("removed"))).alias("unique_fails"),
    )
    steps = [("".join(o), i + 1, f, sum(1 << FILTERS.index(x) for x in o[:i])) for o in permutations(FILTERS) for i, f in enumerate(o)]
    steps = spark.createDataFrame(steps, "filter_order string, step int, letter string, subset int")
    rows = taken.join(F.broadcast(steps), (F.col("filter") == F.col("letter")) & (F.col("before") == F.col("subset")))
    rows = rows.join(each, (F.col("part") == F.col("p")) & (F.col("filter") == F.col("f")))
    return rows.select("part", "filter_order", "step", "kept", "removed", (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails", "good_lost", "toxic_lost", F.col("shapley").cast("long").alias("shapley"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {"op13_filter_audit": op13_filter_audit}
ORACLE = {
    "op13_filter_audit": r"""
WITH l AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
),
f AS (
  SELECT w.part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
         [len(words) < 100, 100 * len(list_distinct(words)) < 80 * len(words), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t),
          regexp_matches(t, '[#$%&*|]'), coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY t), false)] AS fails
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id
),
c AS (SELECT part, good, toxic, fails, count(*) AS n, list_sum([CAST(x AS INT) FOR x IN fails]) AS many FROM f GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT p.x || q.x || r.x || s.x || t.x AS filter_order
  FROM letters p, letters q, letters r, letters s, letters t
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5
),
steps AS (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM orders),
asked AS (SELECT filter_order, step, [instr('ABCDE', filter_order[i]) FOR i IN [1, 2, 3, 4, 5]] AS nth FROM steps),
r AS (
  SELECT c.part, filter_order, step, n, good, toxic, many, nth[step] AS filter, fails[nth[step]] AS failed,
         list_bool_or([fails[nth[i]] AND i < step FOR i IN [1, 2, 3, 4, 5]]) AS gone
  FROM c, asked
),
s AS (
  SELECT part, filter_order, step, filter,
         sum(CASE WHEN NOT gone AND NOT failed THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN NOT gone AND failed THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN gone AND failed THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN failed AND many = 1 THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN NOT gone AND failed THEN n * good ELSE 0 END) AS good_lost,
         sum(CASE WHEN NOT gone AND failed THEN n * toxic ELSE 0 END) AS toxic_lost
  FROM r GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM s
"""
}
