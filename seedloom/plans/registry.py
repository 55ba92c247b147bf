"""Task types and their operators. Other tasks plug in by registering their own functions."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from seedloom.operators import acceptance, intake, sft, splits


@dataclass(frozen=True)
class TaskOperators:
    """The functions a task type provides; all map DataFrames to DataFrames.

    ``discover`` and ``validate`` make up intake, ``accept`` decides candidates, and
    ``detect_labels``, ``distribution``, ``split`` and ``convert`` make up splitting.
    """

    discover: Callable
    validate: Callable[..., DataFrame]
    accept: Callable
    detect_labels: Callable[..., list[str]]
    distribution: Callable[[DataFrame], DataFrame]
    split: Callable[..., DataFrame | None]
    convert: Callable[..., DataFrame]


_TASKS: dict[str, TaskOperators] = {}


def register_task(task_type: str, operators: TaskOperators) -> None:
    _TASKS[task_type] = operators


def task_operators(task_type: str) -> TaskOperators:
    if task_type not in _TASKS:
        raise ValueError(f"task type {task_type!r} is not supported; known: {sorted(_TASKS)}")
    return _TASKS[task_type]


register_task(
    "classification",
    TaskOperators(
        discover=intake.discover_columns,
        validate=intake.map_and_validate,
        accept=acceptance.greedy_accept,
        detect_labels=intake.label_list,
        distribution=intake.label_distribution,
        split=splits.execute_split,
        convert=sft.sft_messages,
    ),
)


def step(inputs: Iterable[str], outputs: Iterable[str]):
    """Declare the columns a ``DataFrame.transform`` function needs and adds."""
    needed, added = set(inputs), set(outputs)

    def declare(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @functools.wraps(function)
        def run(df: DataFrame, *args, **kwargs) -> DataFrame:
            if missing := needed - set(df.columns):
                raise ValueError(f"{function.__name__} needs columns {sorted(missing)}")
            result = function(df, *args, **kwargs)
            if missing := added - set(result.columns):
                raise ValueError(f"{function.__name__} did not add columns {sorted(missing)}")
            return result

        return run

    return declare
