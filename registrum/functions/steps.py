"""Expressions in steps, so that what is used several times is computed, planned and compiled once.

A function in steps is a generator: it yields dictionaries of columns and is sent references to them, and returns its result.
inline() puts the expressions into each other and gives one column. staged() runs several such functions side by side over a
DataFrame; each step becomes columns of their own, which the optimiser does not copy into later ones if they are used more than once.
"""

from __future__ import annotations

from collections.abc import Callable, Generator
from functools import wraps

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Steps = Generator[dict[str, Column], dict[str, Column], Column]


def inline(function: Callable[..., Steps]) -> Callable[..., Column]:
    """The function as one column; its steps stay at hand as .steps."""

    @wraps(function)
    def whole(*args, **options) -> Column:
        steps = function(*args, **options)
        try:
            at = next(steps)
            while True:
                at = steps.send(at)
        except StopIteration as e:
            return e.value

    whole.steps = function
    return whole


def staged(df: DataFrame, **jobs: Steps) -> tuple[DataFrame, dict[str, Column]]:
    """(df with columns for all steps, the results by name). Names of the added columns begin with an underscore and the job's name."""
    results: dict[str, Column] = {}
    waiting = {}

    def go(name: str, sent: dict[str, Column] | None) -> None:
        try:
            waiting[name] = jobs[name].send(sent)
        except StopIteration as e:
            results[name] = e.value

    for name in jobs:
        go(name, None)
    while waiting:
        now, waiting = waiting, {}
        df = df.withColumns({f"_{name}_{k}": c for name, columns in now.items() for k, c in columns.items()})
        for name, columns in now.items():
            go(name, {k: F.col(f"_{name}_{k}") for k in columns})
    return df, results
