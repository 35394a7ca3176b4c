"""Before/after hook around DataFrame -> DataFrame steps.

The hook does not print; it attaches ``DataFrame.observe`` so the row count
(and any extra metric) of a step is gathered by the Spark job that runs it,
on the executors, with no extra pass over the data.
"""

from __future__ import annotations

import functools
import threading

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

_LOCAL = threading.local()     # per driver thread: concurrent runs never mix metrics
_KEEP = 16                     # observations kept per step name (bounded driver memory)


def _registry() -> dict[str, list[Observation]]:
    if not hasattr(_LOCAL, "observations"):
        _LOCAL.observations = {}
    return _LOCAL.observations


def step(name: str, **metrics):
    """Decorate ``fn(df, ...) -> DataFrame``; the result carries an observation
    named ``name`` with ``rows`` = count(*) plus the given metrics (SQL
    aggregate text such as ``"sum(value)"``, or a callable returning a
    Column; both are built when the step runs, not at import)."""

    def wrap(fn):
        @functools.wraps(fn)
        def run(*args, **kwargs) -> DataFrame:
            out = fn(*args, **kwargs)
            obs = Observation(name)
            exprs = [F.count(F.lit(1)).alias("rows")]
            exprs += [(F.expr(c) if isinstance(c, str) else c()).alias(k) for k, c in metrics.items()]
            observed = out.observe(obs, *exprs)
            kept = _registry().setdefault(name, [])
            kept.append(obs)
            del kept[:-_KEEP]
            return observed

        run.step_name = name
        return run

    return wrap


def last_observation(name: str) -> dict:
    """Metrics of the latest run of step ``name`` in this thread (blocks
    until its action ran)."""
    obs = _registry().get(name)
    if not obs:
        raise KeyError(f"no observed step {name!r}")
    return obs[-1].get
