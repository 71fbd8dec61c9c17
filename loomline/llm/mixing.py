"""Mixing sources to target weights by hash-threshold histograms.

Each source gets a target of words. A target of r whole passes and a rest is met by
taking every document r times and, once more, the documents whose hash is up to a
threshold. The threshold comes from nested histograms: words are summed by source and
leading hash bits, the bucket where the rest is reached is found, and only that bucket
is summed again by further bits. Nothing is sorted but one row per source and bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomline.llm.shared import small, written

#: Of 60 hash bits, those that each histogram leaves out.
LEVELS = (48, 36, 0)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def doc_hash(doc_id: Column, text: Column) -> Column:
    """60 bits of the MD5 of the id's digits and the text; null as empty text."""
    both = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(both), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2) -> DataFrame:
    """(source, source_size, target) of (source, size) rows.

    Sources by code point, null last, weigh `weights` in turn. They share `share` of all
    words; a target ends at `most` times its source's words and the excess goes to the
    others by weight until none is above. That is target = min(cap, level * weight) at
    one level, and with the sources by cap / weight the level follows from running sums.
    Window functions run over one row per source only.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    caps = total.select("source", "source_size", cycle.alias("w")).withColumn("cap", F.col("source_size") * most)
    up = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = (
        caps.withColumn("done", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("left", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0)))
        .withColumn("pool", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("level", (F.col("pool") - F.col("done")) / F.col("left"))
        # The level is the first at which the next source does not reach its cap, which is
        # the largest of those; beyond it they fall.
        .withColumn("level", F.max(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.col("level"))).over(everything))
    )
    target = F.when(F.col("level").isNull() | (F.col("cap") <= F.col("level") * F.col("w")), F.col("cap").cast("double"))
    return levels.select("source", "source_size", target.otherwise(F.col("level") * F.col("w")).alias("target"))


def thresholds(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, passes, last): each document counts `passes` times, and once more if h <= last.

    sizes: (source, size, h) with h of 60 bits. `last` is null where none is taken more.
    A document or, for equal hashes, group of documents at the boundary is taken if that
    ends nearer to the target.
    """
    ratio = F.col("target") / F.col("source_size")
    state = targets.withColumn("passes", F.when(F.col("source_size") > 0, F.floor(ratio)).otherwise(0).cast("long"))
    state = state.select("source", "passes", (F.col("target") - F.col("passes") * F.col("source_size")).alias("rest"), F.lit(0).cast("long").alias("base"), F.lit(0).cast("long").alias("at"))
    above = 60
    for bits in LEVELS:
        keys = small(state.select(F.col("source").alias("s"), "at", "base", "passes", "rest"))
        inside = sizes.join(keys, F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("h", above) == F.col("at")))
        sums = inside.groupBy("source", F.shiftright("h", bits).alias("bucket")).agg(F.sum("size").alias("n"), *(F.first(c).alias(c) for c in ("base", "passes", "rest")))
        run = Window.partitionBy("source").orderBy("bucket")
        sums = sums.withColumn("upto", F.col("base") + F.sum("n").over(run)).withColumn("from", F.col("upto") - F.col("n"))
        if bits:
            # The bucket that reaches the rest; none for a source without words.
            hit = sums.filter((F.col("from") <= F.col("rest")) & (F.col("rest") < F.col("upto")))
            state = written(hit.select("source", "passes", "rest", F.col("from").alias("base"), F.col("bucket").alias("at")), "mix-state")
        else:
            taken = (F.col("upto") <= F.col("rest")) | (F.col("upto") - F.col("rest") < F.col("rest") - F.col("from"))
            low = sums.groupBy("source").agg(F.max(F.when(taken, F.col("bucket"))).alias("inside"))
            state = state.alias("a").join(low.alias("b"), F.expr("a.source <=> b.source"), "left").select("a.source", "a.at", "b.inside")
        above = bits
    # What lies before the last boundary bucket is below it, so it needs no list of its own.
    last = F.coalesce(F.col("inside"), F.shiftleft("at", LEVELS[-2]) - 1)
    return state.select("source", last.alias("last"))


def _planned(docs: DataFrame, weights: tuple[int, ...], share: float, most: int) -> tuple[DataFrame, DataFrame]:
    """(sizes of docs, a row per source: _source, source_size, target, _passes, _last)."""
    sizes = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), doc_hash(F.col("doc_id"), F.col("text")).alias("h"))
    sizes = written(sizes, "mix-sizes")
    targets = written(source_targets(sizes, weights, share, most), "mix-targets")
    last = thresholds(sizes, targets)
    per = targets.alias("t").join(last.alias("l"), F.expr("t.source <=> l.source"), "left")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    per = per.select(F.col("t.source").alias("_source"), "source_size", "target", passes.alias("_passes"), F.col("last").alias("_last"))
    return sizes, written(per, "mix-plan")


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2) -> DataFrame:
    """One row per row of docs (doc_id, text, source): doc_id, size, source_size, target, taken.

    `taken` counts the words of all repeats and is at most `most` times `size`. Null and
    empty texts have size 0 and take 0. A null source is a source. Rows with the same id
    and text are taken or left together. An empty table gives an empty one. Other columns of docs
    play no part. It runs on DataFrame functions alone.
    """
    sizes, per = _planned(docs, weights, share, most)
    out = sizes.join(small(per), F.col("source").eqNullSafe(F.col("_source")))
    times = F.least(F.col("_passes") + F.when(F.col("h") <= F.col("_last"), 1).otherwise(0), F.lit(most))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * times).cast("long").alias("taken"))


def apply_mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2) -> DataFrame:
    """docs with each row as often as the mix takes it, 0 to `most` times; rows without words go.

    The columns stay as they are. A row's number follows from its id, text and source, so
    texts are not shuffled.
    """
    columns = [F.col(f"d.`{c}`") for c in docs.columns]
    _, per = _planned(docs, weights, share, most)
    more = F.when(doc_hash(F.col("d.doc_id"), F.col("d.text")) <= F.col("p._last"), 1).otherwise(0)
    times = F.when(word_count(F.col("d.text")) > 0, F.least(F.col("p._passes") + more, F.lit(most))).otherwise(0)
    hit = docs.alias("d").join(small(per).alias("p"), F.col("d.source").eqNullSafe(F.col("p._source")))
    row = hit.select(F.struct(*columns).alias("row"), times.cast("int").alias("times"))
    return row.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("times")))).select("row.*")


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _mix_sql(table: str = "documents", weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2) -> str:
    cycle = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(weights))
    return f"""
WITH sizes AS (
  SELECT doc_id, source,
         CAST(coalesce(length(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS h
  FROM {table}
), total AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source
), caps AS (
  SELECT source, source_size, source_size * {most} AS cap,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} {cycle} END AS w
  FROM total
), levels AS (
  SELECT *, (sum(source_size) OVER () * CAST({share} AS DOUBLE)
             - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / (sum(w) OVER ()
             - coalesce(sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS own
  FROM caps
), lev AS (
  SELECT *, max(CASE WHEN own * w <= cap THEN own END) OVER () AS level FROM levels
), targets AS (
  SELECT source, source_size,
         CASE WHEN level IS NULL OR cap <= level * w THEN CAST(cap AS DOUBLE) ELSE level * w END AS target
  FROM lev
), t AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS passes FROM targets
), cum AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.passes, t.target - t.passes * t.source_size AS rest,
         CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS upto,
         CAST(sum(s.size) OVER (PARTITION BY s.source, s.h) AS BIGINT) AS n
  FROM sizes s JOIN t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(least(size * (passes + CASE WHEN upto <= rest OR upto - rest < rest - (upto - n) THEN 1 ELSE 0 END), size * {most}) AS BIGINT) AS taken
FROM cum"""


QUERIES = {"op3_source_mix": op3_source_mix}
ORACLE = {"op3_source_mix": _mix_sql()}
