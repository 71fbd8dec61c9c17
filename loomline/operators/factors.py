"""Factor analysis: encode features, scale them, and rank what explains a target.

Models are solved from sums of products, which Spark aggregates in one pass; the driver
solves systems whose size is the number of encoded columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

ONE_HOT = 99


def check_arguments(df: DataFrame, target: str, features: list[str]) -> None:
    if not features:
        raise ValueError("at least one feature is needed")
    if target in features:
        raise ValueError("the target must not be a feature")
    missing = [c for c in (target, *features) if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {', '.join(missing)}")


def distinct_counts(df: DataFrame, columns: list[str]) -> dict[str, int]:
    """Number of distinct values by column, in one aggregation; null counts as none."""
    return df.agg(*(F.count_distinct(c).alias(c) for c in columns)).first().asDict()


def numeric(df: DataFrame, c: str) -> Column:
    """The column as a number, null as 0: dates as days, times as seconds, truth as 0 or 1."""
    kind = df.schema[c].dataType
    if isinstance(kind, DateType):
        return F.coalesce(F.date_diff(F.col(c), F.lit("1970-01-01").cast("date")).cast("double"), F.lit(0.0))
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        epoch = F.lit("1970-01-01 00:00:00").cast(kind)
        return F.coalesce(F.timestamp_diff("MICROSECOND", epoch, F.col(c)) / 1e6, F.lit(0.0))
    return F.coalesce(F.col(c).cast("double"), F.lit(0.0))


def encode(df: DataFrame, target: str, features: list[str], keep: tuple[str, ...] = (), drop_null: bool = False) -> tuple[DataFrame, dict[str, list[str]]]:
    """(table, encoded columns by feature): numbers as they are, text one-hot or by frequency.

    Null numbers count as 0; with drop_null, rows with a null feature or target go instead.

    Constant features go. Text of 2 to 99 distinct values becomes a column per value, more
    become the value's number of rows, null being a value of its own. Frequencies are joined,
    so a frequent value is not gathered in a window.
    """
    check_arguments(df, target, features)
    df = df.dropna(subset=[target, *features]) if drop_null else df
    counts = distinct_counts(df, features)
    groups: dict[str, list[str]] = {}
    columns = [F.col(c) for c in keep] + [numeric(df, target).alias(target)]
    for f in features:
        if counts[f] <= 1:
            continue
        if isinstance(df.schema[f].dataType, (NumericType, DateType, TimestampType, TimestampNTZType)) or df.schema[f].dataType.simpleString() == "boolean":
            columns.append(numeric(df, f).alias(f))
            groups[f] = [f]
        elif counts[f] <= ONE_HOT:
            values = sorted(r[0] for r in df.select(f).filter(F.col(f).isNotNull()).distinct().collect())
            names = [f"{f}={v}" for v in values]
            columns += [F.when(F.col(f) == v, 1.0).otherwise(0.0).alias(n) for v, n in zip(values, names, strict=True)]
            groups[f] = names
        else:
            per = df.groupBy(F.col(f).alias(f"_k_{f}")).agg(F.count("*").cast("double").alias(f"_n_{f}"))
            df = df.join(per, F.col(f).eqNullSafe(F.col(f"_k_{f}")), "left")
            columns.append(F.col(f"_n_{f}").alias(f))
            groups[f] = [f]
    return df.select(*columns), groups


def min_max(df: DataFrame, columns: list[str]) -> DataFrame:
    """df with the columns scaled to 0..1; constant ones become 0. The ends are one row of an aggregate."""
    ends = df.agg(F.struct(*(x for i, c in enumerate(columns) for x in (F.min(F.col(f"`{c}`")).cast("double").alias(f"a{i}"), F.max(F.col(f"`{c}`")).cast("double").alias(f"b{i}"))))).scalar()
    table = df.withColumn("_ends", ends)
    out = {}
    for i, c in enumerate(columns):
        a, b = F.col(f"_ends.a{i}"), F.col(f"_ends.b{i}")
        out[c] = F.when(b > a, (F.col(f"`{c}`") - a) / (b - a)).otherwise(0.0)
    return table.select(*(F.col(f"`{c}`") for c in df.columns if c not in out), *(v.alias(c) for c, v in out.items()))


def hash_split(key: Column, test: float = 0.25) -> Column:
    """Whether a row is in the test part, by its key's hash; the split of our own is stable."""
    return F.pmod(F.xxhash64(key), F.lit(10_000)) < int(test * 10_000)


def moments(df: DataFrame, columns: list[str], target: str, fold: Column | None = None) -> dict:
    """By fold: (n, sums, products) of the columns and the target, in one pass.

    Each task adds up outer products of its rows in blocks; what it sends on has as many
    values as there are pairs of columns, and they are added up by pair.
    """
    names = [*columns, target]
    k = len(names)
    rows = df.select((fold if fold is not None else F.lit(0)).cast("long").alias("fold"), F.array(*(F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in names)).alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            folds = batch.column(0).to_numpy(zero_copy_only=False)
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            x = np.concatenate((np.ones((len(x), 1)), x), axis=1)
            for f in np.unique(folds).tolist():
                part = x[folds == f]
                total[f] = total.get(f, 0) + part.T @ part
        i, j = np.triu_indices(k + 1)
        for f, sums in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), f)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(sums[i, j])], ["fold", "i", "j", "v"])

    sums = rows.mapInArrow(run, "fold long, i int, j int, v double").groupBy("fold", "i", "j").agg(F.sum("v").alias("v")).collect()
    out: dict[int, np.ndarray] = {}
    for r in sums:
        both = out.setdefault(r.fold, np.zeros((k + 1, k + 1)))
        both[r.i, r.j] = both[r.j, r.i] = r.v
    return {f: (int(round(m[0, 0])), m[0, 1:], m[1:, 1:]) for f, m in out.items()}


def _add(parts) -> tuple:
    parts = list(parts)
    return sum(p[0] for p in parts), sum(p[1] for p in parts), sum(p[2] for p in parts)


def solve(m: tuple, chosen: list[int], alpha: float = 1.0) -> tuple[np.ndarray, float]:
    """Ridge weights and offset of the chosen columns from moments; the target comes last."""
    n, s, p = m
    mean = s / n
    cov = p - n * np.outer(mean, mean)
    x = np.ix_(chosen, chosen)
    w = np.linalg.lstsq(cov[x] + alpha * np.eye(len(chosen)), cov[chosen, -1], rcond=None)[0]
    return w, float(mean[-1] - mean[chosen] @ w)


def r2(m: tuple, chosen: list[int], w: np.ndarray, b: float) -> float:
    """Explained share of the target's variance over the rows of m; 0 where it has none."""
    n, s, p = m
    yy = p[-1, -1] - s[-1] ** 2 / n
    sse = p[-1, -1] - 2 * (w @ p[chosen, -1] + b * s[-1]) + w @ p[np.ix_(chosen, chosen)] @ w + 2 * b * (w @ s[chosen]) + n * b * b
    return float(1 - sse / yy) if yy > 1e-12 else 0.0


def importances(df: DataFrame, target: str, features: list[str], key: str, folds: int = 5, extended: bool = False, fold: Column | None = None, test: Column | None = None) -> DataFrame:
    """(feature, r2_drop, ridge, shap, permutation, score): views of each feature's weight, in percent.

    r2_drop is the loss of the best fold's r2 without the feature, ridge the norm of its
    coefficients over their number, shap its share of linear attributions, on average or, if
    `test` says test rows by the key or a feature, in the first of them by a least-angle fit of
    the others, permutation the
    rise of the squared error that shuffling it brings on average, which is twice the
    variance of its part of the prediction. score blends them as (c * r2_drop + ridge + 4 *
    shap) / (c + 5), where c is 5, and 0 if any r2_drop is not positive; extended, c is 9 and
    4 * permutation joins, over c + 9. Folds follow the key's hash, or `fold`. "other" is
    100 * (1 - r2) of the full model.
    """
    table, groups = encode(df, target, features, keep=(key,))
    columns = [c for g in groups.values() for c in g]
    table = min_max(table, [*columns, target])
    parts = moments(table, columns, target, fold if fold is not None else F.pmod(F.xxhash64(key), F.lit(folds)))
    whole = _add(parts.values())
    at = {c: i for i, c in enumerate(columns)}

    def best(chosen: list[int]) -> float:
        if not chosen:
            return 0.0
        return max(r2(parts[k], chosen, *solve(_add(v for j, v in parts.items() if j != k), chosen)) for k in parts) if len(parts) > 1 else r2(whole, chosen, *solve(whole, chosen))

    everything = list(range(len(columns)))
    full = best(everything)
    w, b = solve(whole, everything)
    n, s, p = whole
    cov = p / n - np.outer(s / n, s / n)
    spread = np.sqrt(np.maximum(np.diag(cov)[:-1], 0))
    rows = []
    for f, names in groups.items():
        own = [at[c] for c in names]
        shuffled = float(2 * w[own] @ cov[np.ix_(own, own)] @ w[own])
        rows.append([f, full - best([i for i in everything if i not in own]), float(np.sqrt((w[own] ** 2).sum()) / len(own)), float(np.abs(w[own] * spread[own]).sum()), shuffled])
    if test is not None:
        from loomline.operators.leastangle import first_row_shares

        first = {r.feature: r.share for r in first_row_shares(table, [key], target, groups, test).collect()}
        for r in rows:
            r[3] = first.get(r[0], 0.0)
    share = lambda k: [100 * r[k] / (sum(abs(x[k]) for x in rows) or 1.0) for r in rows]
    drop, ridge, shap, perm = share(1), share(2), share(3), share(4)
    c = 0 if any(r[1] <= 0 for r in rows) else 9 if extended else 5
    score = [(c * d + a + 4 * h + (4 * q if extended else 0)) / (c + (9 if extended else 5)) for d, a, h, q in zip(drop, ridge, shap, perm, strict=True)]
    out = list(zip((r[0] for r in rows), drop, ridge, shap, perm, score, strict=True))
    other = 100 * (1 - r2(whole, everything, w, b))
    return df.sparkSession.createDataFrame([*out, ("other", None, None, None, None, other)], "feature string, r2_drop double, ridge double, shap double, permutation double, score double")


def k_best(rows: DataFrame, target: str, features: list[str], share: float = 0.3) -> DataFrame:
    """(feature, r2, rank) of the features that explain the target best alone, a share of them and one at least.

    They are ranked by squared correlation, in which the F statistic of a regression grows.
    """
    n, s, p = moments(rows, features, target)[0]
    cov = p / n - np.outer(s / n, s / n)
    spread = np.diag(cov)
    score = [float(cov[i, -1] ** 2 / (spread[i] * spread[-1])) if spread[i] * spread[-1] > 1e-18 else 0.0 for i in range(len(features))]
    order = sorted(range(len(features)), key=lambda i: (-score[i], features[i]))[: max(1, int(len(features) * share))]
    return rows.sparkSession.createDataFrame([(features[i], score[i], r + 1) for r, i in enumerate(order)], "feature string, r2 double, rank int")


def frequency_encoded(df: DataFrame, c: str) -> DataFrame:
    """df with the number of rows that share the value of c, null being a value."""
    per = df.groupBy(F.col(c).alias("_k")).agg(F.count("*").alias(f"{c}_freq"))
    return df.join(per, F.col(c).eqNullSafe(F.col("_k")), "left").drop("_k")


def share_within(df: DataFrame, group: list[str], c: str) -> DataFrame:
    """(group, c, n, share): value counts of c, as shares of their group."""
    n = df.groupBy(*group, c).agg(F.count("*").alias("n"))
    return n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*group)))
