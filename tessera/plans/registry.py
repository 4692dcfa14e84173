"""Named analyses (K10/F1/F2): register user code under a name, run it by name.

An analysis is ``f(spark, inputs: dict[str, DataFrame], state: dict) -> DataFrame
| dict[str, DataFrame]``.  Its declared table dependencies are registered as
temp views before it runs (lazy: nothing is read until the result is used);
its declared outputs are checked.  Given a :class:`~tessera.streaming.store.StateStore`
as state, the outputs an analysis declares to keep are put there as new
versions, so the next analysis (also of another session) finds them.
Everything is an in-process call -- no server, no port.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..streaming.store import StateStore


@dataclass
class Analysis:
    name: str
    fn: Callable
    deps: tuple[str, ...] = ()
    outputs: tuple[str, ...] | None = None
    keeps: tuple[str, ...] = ()
    returns: str | None = None


_ANALYSES: dict[str, Analysis] = {}


def register_analysis(name: str, fn: Callable, deps: Sequence[str] = (),
                      outputs: Sequence[str] | None = None, replace: bool = True,
                      keeps: Sequence[str] = (), returns: str | None = None) -> Analysis:
    """``keeps``: outputs stored when the state is a store; ``returns``: the one output handed to the caller."""
    if name in _ANALYSES and not replace:
        raise ValueError(f"analysis {name!r} already registered")
    a = Analysis(name, fn, tuple(deps), tuple(outputs) if outputs else None, tuple(keeps), returns)
    _ANALYSES[name] = a
    return a


def analysis(name: str, deps: Sequence[str] = (), outputs: Sequence[str] | None = None):
    """Decorator form of :func:`register_analysis`."""

    def deco(fn):
        register_analysis(name, fn, deps, outputs)
        return fn

    return deco


class UnknownAnalysis(KeyError):
    pass


def run_analysis(spark: SparkSession, name: str, tables: dict[str, DataFrame] | None = None,
                 state: dict | StateStore | None = None):
    """Look up ``name``, register its dependencies as views, run it, check outputs, keep what it declares."""
    if name not in _ANALYSES:
        from . import q_stream  # noqa: F401  (registers the built-in analyses)
    if name not in _ANALYSES:
        raise UnknownAnalysis(name)
    a = _ANALYSES[name]
    tables = tables or {}
    inputs = {}
    for d in a.deps:
        if d in tables:
            tables[d].createOrReplaceTempView(d)
        inputs[d] = spark.table(d)
    result = a.fn(spark, inputs, state if state is not None else {})
    if a.outputs is not None:
        if not isinstance(result, dict):
            raise TypeError(f"analysis {name!r} declares outputs {a.outputs} but returned one table")
        missing = [o for o in a.outputs if o not in result]
        if missing:
            raise KeyError(f"analysis {name!r} did not produce {missing}")
    if isinstance(state, StateStore):
        for k in a.keeps:
            state.put(k, result[k], analysis=name)
    return result[a.returns] if a.returns else result


@dataclass
class Script:
    """Chainable analysis call with named inputs and declared outputs (F2).

    ``Script(fn, outputs=["analysis", "h"]).input("df", points).with_state(st).execute(spark)``
    """

    fn: Callable
    outputs: Sequence[str] = ()
    inputs: dict = field(default_factory=dict)
    state: dict = field(default_factory=dict)

    def input(self, name: str, df: DataFrame) -> "Script":
        self.inputs[name] = df
        return self

    def with_state(self, state: dict) -> "Script":
        self.state.update(state)
        return self

    def as_val(self, name: str) -> "Script":
        self.outputs = tuple(self.outputs) + (name,)
        return self

    def execute(self, spark: SparkSession) -> dict[str, DataFrame]:
        res = self.fn(spark, self.inputs, self.state)
        missing = [o for o in self.outputs if o not in res]
        if missing:
            raise KeyError(f"script did not produce {missing}")
        return {o: res[o] for o in self.outputs}
