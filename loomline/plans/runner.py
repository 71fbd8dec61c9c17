"""Models by name: arguments bound from a description, results in plain types."""

from __future__ import annotations

import inspect
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, MapType, StructType

from loomline.eventlog import EventLog
from loomline.functions import scalar
from loomline.operators import cluster, happypath, insights, metrics, series

_TRUE, _FALSE = frozenset("y yes t true on 1".split()), frozenset("n no f false off 0".split())


def truth(text: object) -> bool:
    """A bool from its usual names in any case; others raise ValueError."""
    if isinstance(text, bool):
        return text
    word = str(text).strip().lower()
    if word in _TRUE:
        return True
    if word in _FALSE:
        return False
    raise ValueError(f"not a truth value: {text!r}")


def coerced(value: object, kind: type | None) -> object:
    """A value as the kind that an argument has by default: texts lose quotes and become lists, numbers or truths."""
    if isinstance(value, str):
        value = value.strip().strip("\"'")
        if kind in (list, tuple):
            value = [x.strip().strip("\"'") for x in value.strip("[]()").split(",") if x.strip()]
    if kind is bool:
        return truth(value)
    if kind in (int, float) and value is not None:
        return kind(value)
    if kind in (list, tuple):
        return kind(value)
    return value


@dataclass(frozen=True)
class Model:
    """A function of a log and named arguments, whose defaults say their kinds."""

    run: Callable[..., DataFrame]
    defaults: dict[str, object] = field(default_factory=dict)

    def bound(self, params: dict[str, object]) -> dict[str, object]:
        unknown = set(params) - set(self.defaults)
        if unknown:
            raise ValueError(f"unknown arguments: {', '.join(sorted(unknown))}; known are {', '.join(self.defaults)}")
        return {k: coerced(params.get(k, v), type(v) if v is not None else None) for k, v in self.defaults.items()}


def model(f: Callable[..., DataFrame]) -> Model:
    """A model whose arguments are those of f after the log."""
    return Model(f, {p.name: p.default for p in list(inspect.signature(f).parameters.values())[1:]})


def _metrics(log: EventLog, family: str = "activity", unit: str = "hour", names: list = []) -> DataFrame:  # noqa: B006
    of = metrics.FAMILIES[family](log, unit, 6)
    return of.calc(*names) if names else of.apply()


def _insights(log: EventLog, output_type: str = "clustered", hour_cost: float = 1.0) -> DataFrame:
    return insights.insight_output(log, output_type, hour_cost)


def _happy_path(log: EventLog, floor: float = 0.05, key_node: str = None, key_reward: float = 1.0, end_reward: float = 0.0, gamma: float = 0.9, increase: float = 0.3, mode: str = "plain", initial_state: str = "start", short_path: int = None, penalty: float = None) -> DataFrame:  # noqa: RUF013
    """The mode plain knows no layers; initial and final are those of layered_edges."""
    how = {"start": initial_state, "gamma": gamma, "increase": increase}
    if mode == "plain":
        return happypath.best_path(happypath.rewards(log, floor, key_node, key_reward, end_reward), **how)
    if key_node is None:
        raise ValueError("layers need a key node")
    edges = happypath.layered_edges(log, key_node, mode, floor, short_path, key_reward, end_reward, penalty)
    return happypath.best_layered_path(edges, **how)


def _forecast(log: EventLog, period: str = "D", steps: int = 5, kinds: tuple = ("last", "holt", "ridge"), comma: bool = True) -> DataFrame:
    return series.forecast_table(series.node_series(log, period), series.Plan(period, steps, kinds), comma)


def _stages(log: EventLog, generalizing_ability: float = 0.5) -> DataFrame:
    return cluster.with_clusters(log.df, log.activity, cluster.stage_clusters(log.df, log.activity, generalizing_ability))


MODELS = {name: model(f) for name, f in {"metrics": _metrics, "auto_insights": _insights, "happy_path": _happy_path, "forecast": _forecast, "stage_clusters": _stages}.items()}


def plain(df: DataFrame) -> DataFrame:
    """df with arrays and truths as text, and maps and structs as JSON, as the schema says."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, ArrayType) and not isinstance(f.dataType.elementType, (ArrayType, MapType, StructType)):
            c = scalar.joined(c)
        elif isinstance(f.dataType, (ArrayType, MapType, StructType)):
            c = F.to_json(c)
        elif isinstance(f.dataType, BooleanType):
            c = scalar.truth_text(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def run_model(name: str, log: EventLog, params: dict[str, object] | None = None, models: dict[str, Model] = MODELS) -> DataFrame:
    """The result of a model by name, in plain types. Unknown names and arguments raise ValueError."""
    if name not in models:
        raise ValueError(f"unknown model {name!r}; known are {', '.join(models)}")
    chosen = models[name]
    return plain(chosen.run(log, **chosen.bound(params or {})))
