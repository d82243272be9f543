"""Pipelines of DataFrame functions, in Python or from a YAML file.

A pipeline is one logical plan: Spark runs nothing until its result is used, and fuses what it can across steps.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Step:
    """A named function of a DataFrame; ``needs`` are the columns it reads, checked before it runs."""

    name: str
    function: Callable[[DataFrame], DataFrame]
    needs: tuple[str, ...] = ()

    def __call__(self, df: DataFrame) -> DataFrame:
        if missing := set(self.needs) - set(df.columns):
            raise ValueError(f"step {self.name!r} needs columns {sorted(missing)}")
        return self.function(df)


def step(function: Callable[..., DataFrame] | None = None, *, needs: tuple[str, ...] = ()):
    """Decorator: calling the function with its options gives a step."""

    def wrap(f: Callable[..., DataFrame]) -> Callable[..., Step]:
        return lambda **options: Step(f.__name__, lambda df: f(df, **options), needs)

    return wrap(function) if function else wrap


@dataclass
class Pipeline:
    name: str
    steps: list[Step] = field(default_factory=list)

    def then(self, function: Step | Callable[..., DataFrame], *args, **options) -> Pipeline:
        """This pipeline and one more step; a plain function gets the DataFrame first."""
        one = function if isinstance(function, Step) else Step(getattr(function, "__name__", "step"), lambda df: function(df, *args, **options))
        return Pipeline(self.name, [*self.steps, one])

    def run(self, df: DataFrame) -> DataFrame:
        return reduce(lambda d, s: s(d), self.steps, df)

    def describe(self) -> str:
        return "\n".join([f"Pipeline {self.name}", *(f"  {i}. {s.name}" + (f" (needs {', '.join(s.needs)})" if s.needs else "") for i, s in enumerate(self.steps, 1))])


def _target(path: str) -> Callable:
    module, _, name = path.rpartition(".")
    return getattr(importlib.import_module(module), name)


def _value(raw):
    """An option; a mapping with ``call`` is a function of the library called with the rest."""
    if isinstance(raw, dict) and "call" in raw:
        return _target(raw["call"])(**{k: _value(v) for k, v in raw.items() if k != "call"})
    if isinstance(raw, dict) and "function" in raw:
        return _target(raw["function"])
    return [_value(v) for v in raw] if isinstance(raw, list) else raw


def from_yaml(spark: SparkSession, text: str) -> Callable[[], DataFrame]:
    """A run described in YAML: ``read`` and ``steps`` name functions, other keys are their options; ``write`` is optional.

    Functions are named from ``sievework.`` on only, so that a file can't call others.
    """
    import yaml

    plan = yaml.safe_load(text)

    def named(raw: dict) -> tuple[Callable, dict]:
        if not raw["call"].startswith("sievework."):
            raise ValueError(f"{raw['call']!r} isn't of this library")
        return _target(raw["call"]), {k: _value(v) for k, v in raw.items() if k != "call"}

    def run() -> DataFrame:
        read, options = named(plan["read"])
        df = read(spark, **options)
        for raw in plan.get("steps", []):
            function, options = named(raw)
            df = function(df, **options)
        if "write" in plan:
            write, options = named(plan["write"])
            write(df, **options)
        return df

    return run
