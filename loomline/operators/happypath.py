"""Decision process learnt from a log: transition probabilities, rewards, and best paths.

The tables are plans over the log. States are activities, so an edge list has their number
squared at most; it is solved on the driver up to a checked size and by joins beyond it.
"""

from __future__ import annotations

from dataclasses import replace

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.eventlog import EventLog, with_sentinels
from loomline.sources.scratch import written

#: Edges that the driver solves; more are solved by joins.
EDGES = 200_000


def start_distribution(log: EventLog, floor: float = 0.05) -> DataFrame:
    """(activity, probability) of first events above the floor, not scaled up again."""
    first = log.base().filter(F.col("activity_num") == 1).filter(F.col("activity").isNotNull())
    share = first.groupBy("activity").agg(F.count("*").alias("n")).withColumn("probability", F.col("n") / first.agg(F.count("*")).scalar())
    return share.filter(F.col("probability") > floor).select("activity", "probability")


def _steps(log: EventLog) -> DataFrame:
    """(case_id, activity, next_activity, duration_us) with start and end events."""
    w = Window.partitionBy("case_id").orderBy("pos")
    return with_sentinels(log).withColumn("next_activity", F.lead("activity").over(w))


def conditional_probabilities(log: EventLog, floor: float = 0.0) -> DataFrame:
    """(activity, next_activity, n, probability): shares above the floor, scaled to 1 per activity."""
    n = _steps(log).dropna(subset=["activity", "next_activity"]).groupBy("activity", "next_activity").agg(F.count("*").alias("n"))
    w = Window.partitionBy("activity")
    kept = n.withColumn("p", F.col("n") / F.sum("n").over(w)).filter(F.col("p") > floor)
    return kept.select("activity", "next_activity", "n", (F.col("p") / F.sum("p").over(w)).alias("probability"))


def rewards(log: EventLog, floor: float = 0.0, key_node: str | None = None, key_reward: float = 1.0, end_reward: float = 0.0) -> DataFrame:
    """(activity, next_activity, probability, reward).

    An edge lasts as long as its target does on average (minutes); durations are divided by
    their mean over edges and the reward is minus that. Edges into the key node and into the
    end get the given rewards instead.
    """
    edges = conditional_probabilities(log, floor)
    nodes = with_sentinels(log).groupBy(F.col("activity").alias("next_activity")).agg((F.avg("duration_us") / 6e7).alias("minutes"))
    timed = edges.join(nodes, "next_activity")
    mean = F.nullif(timed.agg(F.avg("minutes")).scalar(), F.lit(0.0))
    scaled = timed.withColumn("norm", F.coalesce(F.col("minutes") / mean, F.lit(0.0)))
    reward = F.when(F.col("next_activity") == "end", F.lit(end_reward))
    if key_node is not None:
        reward = reward.when(F.col("next_activity") == key_node, F.lit(key_reward))
    return scaled.select("activity", "next_activity", "probability", reward.otherwise(-F.col("norm")).alias("reward"))


def actions(edges: DataFrame, increase: float = 0.3) -> DataFrame:
    """(activity, action, next_activity, probability): an action adds `increase` to the way to its target."""
    choice = edges.select(F.col("activity").alias("a"), F.col("next_activity").alias("action"))
    both = edges.join(choice, F.col("activity") == F.col("a"))
    raised = F.col("probability") + F.when(F.col("action") == F.col("next_activity"), increase).otherwise(0.0)
    return both.select("activity", "action", "next_activity", (raised / (1 + increase)).alias("probability"), "reward")


def inconsistent(table: DataFrame, keys: tuple[str, ...] = ("activity", "action")) -> DataFrame:
    """Keys whose probabilities do not add up to 1."""
    return table.groupBy(*keys).agg(F.sum("probability").alias("total")).filter(F.abs(F.col("total") - 1) > 1e-10)


def layers(log: EventLog, key_node: str) -> DataFrame:
    """(case_id, layer): how often the key node occurs in a case."""
    return log.base().groupBy("case_id").agg(F.count(F.when(F.col("activity") == key_node, 1)).alias("layer"))


def states(edges: DataFrame) -> DataFrame:
    """(activity, state, actions): states numbered from 1 by name, "end" last, with their legal actions in order."""
    names = edges.select("activity").union(edges.select("next_activity")).distinct()
    order = Window.orderBy(F.col("activity") == "end", "activity")
    legal = edges.groupBy(F.col("activity").alias("_a")).agg(F.sort_array(F.collect_list("next_activity")).alias("actions"))
    numbered = names.withColumn("state", F.row_number().over(order))  # one row per activity
    out = numbered.join(legal, F.col("activity") == F.col("_a"), "left")
    return out.select("activity", "state", F.coalesce("actions", F.array().cast("array<string>")).alias("actions"))


def layered_rewards(log: EventLog, key_node: str, floor: float = 0.0, short_path: int | None = None, key_reward: float = 1.0, end_reward: float = 0.0) -> DataFrame:
    """(layer, activity, next_activity, probability, reward): a decision process by visits of the key node.

    Layers -2 and 0 are learnt from all cases with shares above the floor, -1 from all without
    a floor, and layer k from 1 on from the cases that visit the key node k times. With
    short_path, the key node's reward turns into a penalty in layer -2 and in the layers
    beyond short_path. Layers without cases are not there.
    """
    visits = layers(log, key_node).select(F.col("case_id").alias("_case"), F.col("layer").cast("int").alias("layer")).filter("layer > 0")
    kept = log.df.join(visits, F.col(log.case) == F.col("_case")).drop("_case")
    steps = {"rest": _steps(log).select(F.explode(F.array(F.lit(-2), F.lit(-1), F.lit(0))).alias("layer"), "activity", "next_activity", "duration_us")}
    by_case = _steps(replace(log, df=kept)).join(visits, F.col("case_id") == F.col("_case")).select("layer", "activity", "next_activity", "duration_us")
    rows = steps["rest"].union(by_case)
    n = rows.dropna(subset=["activity", "next_activity"]).groupBy("layer", "activity", "next_activity").agg(F.count("*").alias("n"))
    w = Window.partitionBy("layer", "activity")
    least = F.when(F.col("layer") == -1, 0.0).otherwise(float(floor))
    edges = n.withColumn("p", F.col("n") / F.sum("n").over(w)).filter(F.col("p") > least).withColumn("probability", F.col("p") / F.sum("p").over(w))
    nodes = rows.groupBy("layer", F.col("activity").alias("next_activity")).agg((F.avg("duration_us") / 6e7).alias("minutes"))
    # A layer's edges are few: they are the activities squared at most.
    timed = edges.join(nodes, ["layer", "next_activity"])
    norm = F.coalesce(F.col("minutes") / F.nullif(F.avg("minutes").over(Window.partitionBy("layer")), F.lit(0.0)), F.lit(0.0))
    penalised = F.lit(False) if short_path is None else (F.col("layer") == -2) | (F.col("layer") > short_path)
    key = F.when(penalised, -abs(float(key_reward))).otherwise(float(key_reward))
    reward = F.when(F.col("next_activity") == "end", F.lit(float(end_reward))).when(F.col("next_activity") == key_node, key).otherwise(-norm)
    return timed.select("layer", "activity", "next_activity", "probability", reward.alias("reward"))


def _gains(value: Column, gamma: float) -> Column:
    return F.col("reward") + gamma * value


def _solved_by_joins(edges: DataFrame, gamma: float, increase: float, tolerance: float, most: int) -> DataFrame:
    edges = written(edges.select("activity", "next_activity", "probability", "reward"), "mdp-edges")
    values = edges.select("activity").union(edges.select("next_activity")).distinct().select("activity", F.lit(0.0).alias("value"))
    for _ in range(most):
        ahead = values.toDF("next_activity", "value")
        gain = _gains(F.col("value"), gamma)
        new = edges.join(ahead, "next_activity").groupBy(F.col("activity").alias("_a")).agg(((F.sum(F.col("probability") * gain) + increase * F.max(gain)) / (1 + increase)).alias("_new"))
        both = written(values.join(new, F.col("activity") == F.col("_a"), "left").select("activity", F.coalesce("_new", F.lit(0.0)).alias("value"), F.abs(F.coalesce("_new", F.lit(0.0)) - F.col("value")).alias("_moved")), "mdp-values")
        values = both.select("activity", "value")
        if (both.agg(F.max("_moved")).first()[0] or 0.0) < tolerance:
            break
    gain = _gains(F.col("value"), gamma)
    best = edges.join(values.toDF("next_activity", "value"), "next_activity").groupBy(F.col("activity").alias("_a")).agg(F.min_by("next_activity", F.struct(-gain, "next_activity")).alias("action"))
    return values.join(best, F.col("activity") == F.col("_a"), "left").select("activity", "value", "action")


def value_iteration(edges: DataFrame, gamma: float = 0.9, increase: float = 0.3, tolerance: float = 1e-3, most: int = 1000, on_driver: int = EDGES) -> DataFrame:
    """(activity, value, action): V(s) = max over actions of the expected reward plus gamma V, and the best action.

    An action adds `increase` to the way to its target before probabilities are scaled, so
    its worth is (sum of p * gain + increase * gain of the target) / (1 + increase), and a
    round needs one pass over the edges. Rounds start from 0 and end when no value moves by
    the tolerance; of equal actions the first by name wins. States without edges are worth 0.
    """
    edges = edges.select("activity", "next_activity", "probability", "reward")
    table = edges.limit(on_driver + 1).toPandas()
    if len(table) > on_driver:
        return _solved_by_joins(edges, gamma, increase, tolerance, most)
    table = table.sort_values(["activity", "next_activity"])
    names = sorted({*table["activity"], *table["next_activity"]})
    at = {s: i for i, s in enumerate(names)}
    own, to = (np.array([at[a] for a in table[c]], dtype=np.int64) for c in ("activity", "next_activity"))
    p, r = table["probability"].to_numpy(dtype=float), table["reward"].to_numpy(dtype=float)
    first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))) if len(own) else np.empty(0, np.int64)
    value = np.zeros(len(names))
    for _ in range(most if len(own) else 0):
        gain = r + gamma * value[to]
        new = np.zeros(len(names))
        new[own[first]] = (np.add.reduceat(p * gain, first) + increase * np.maximum.reduceat(gain, first)) / (1 + increase)
        done = np.abs(new - value).max() < tolerance
        value = new
        if done:
            break
    gain = r + gamma * value[to]
    best = {}
    for i in np.lexsort((to, -gain)).tolist():
        best.setdefault(names[own[i]], names[to[i]])
    return edges.sparkSession.createDataFrame([(s, float(value[at[s]]), best.get(s)) for s in names], "activity string, value double, action string")


#: Between the activity and the layer in the name of a state of the layered process.
_LAYER = "\x1f"


def layered_edges(log: EventLog, key_node: str, mode: str = "final", floor: float = 0.0, short_path: int | None = None, key_reward: float = 1.0, end_reward: float = 0.0, penalty: float | None = None) -> DataFrame:
    """(layer, activity, next_layer, next_activity, probability, reward): moves of the layered process.

    A case begins in layer 0. In the final mode a step to the key node goes on to the next
    larger layer that has cases, whose probabilities and rewards hold from there; in the
    last one it stays. In the initial mode all is layer 0. Beyond short_path the key node
    costs the penalty, or its own reward if none is given.
    """
    if mode not in ("initial", "final"):
        raise ValueError(f"unknown mode {mode!r}; known are initial and final")
    edges = layered_rewards(log, key_node, floor, short_path, key_reward, end_reward).filter("layer >= 0")
    if mode == "initial":
        edges = edges.filter("layer = 0")
    edges = written(edges, "mdp-layers")
    if penalty is not None and short_path is not None:
        edges = edges.withColumn("reward", F.when((F.col("next_activity") == key_node) & (F.col("layer") > short_path), -abs(float(penalty))).otherwise(F.col("reward")))
    # One row for each layer.
    order = edges.select(F.col("layer").alias("_layer")).distinct().withColumn("_next", F.lead("_layer", 1).over(Window.orderBy("_layer")))
    moved = edges.join(order, F.col("layer") == F.col("_layer"))
    goes_on = F.when(F.col("next_activity") == key_node, F.col("_next"))
    return moved.select("layer", "activity", F.coalesce(goes_on, F.col("layer")).alias("next_layer"), "next_activity", "probability", "reward")


def solve_layers(edges: DataFrame, **how) -> DataFrame:
    """(layer, activity, value, action, next_layer): the layered process of layered_edges solved as by value_iteration.

    A state is an activity in a layer. Of equal actions the first by name wins.
    """
    state = lambda layer, activity: F.concat_ws(_LAYER, activity, F.col(layer).cast("string"))
    plain = edges.select(state("layer", "activity").alias("activity"), state("next_layer", "next_activity").alias("next_activity"), "probability", "reward")
    part = lambda c, i: F.split_part(c, F.lit(_LAYER), F.lit(i))
    solved = value_iteration(plain, **how)
    return solved.select(part("activity", 2).cast("int").alias("layer"), part("activity", 1).alias("activity"), "value", part("action", 1).alias("action"), part("action", 2).cast("int").alias("next_layer"))


def _followed(policy: DataFrame, state: list[str], target: list[str], start: tuple, most: int, on_driver: int) -> list[tuple]:
    """States from a start to one without action or seen before, by at most so many steps; a large policy is asked step by step."""
    rows = policy.select(*state, *target).limit(on_driver + 1).collect()
    known = {tuple(r[: len(state)]): tuple(r[len(state) :]) for r in rows} if len(rows) <= on_driver else None

    def action(at: tuple) -> tuple | None:
        if known is not None:
            return known.get(at)
        where = F.lit(True)
        for c, x in zip(state, at, strict=True):
            where = where & (F.col(c) == x)
        row = policy.filter(where).select(*target).first()
        return row and tuple(row)

    path = [start]
    while (found := action(path[-1])) and None not in found and found not in path and len(path) <= most:
        path.append(found)
    return path


def best_path(edges: DataFrame, most: int = 100, start: str = "start", on_driver: int = EDGES, **how) -> DataFrame:
    """(step, activity): from a start, each time the target of the best action, until end or a repeat."""
    policy = value_iteration(edges, on_driver=on_driver, **how)
    path = _followed(policy, ["activity"], ["action"], (start,), most, on_driver)
    return edges.sparkSession.createDataFrame([(i, a) for i, (a,) in enumerate(path)], "step int, activity string")


def best_layered_path(edges: DataFrame, most: int = 100, start: str = "start", on_driver: int = EDGES, **how) -> DataFrame:
    """(step, layer, activity): the best path of the layered process from a start in layer 0, until end or a repeat of a state."""
    policy = solve_layers(edges, on_driver=on_driver, **how)
    path = _followed(policy, ["layer", "activity"], ["next_layer", "action"], (0, start), most, on_driver)
    return edges.sparkSession.createDataFrame([(i, *x) for i, x in enumerate(path)], "step int, layer int, activity string")
