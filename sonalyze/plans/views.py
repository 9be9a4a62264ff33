"""Read models over the ledger: task list, task story, funnel of a task. JSON and table show the same rows."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonalyze.operators.audit import seconds


class DetailResolver(Protocol):
    """A module's way from a stage to its details."""

    def details(self, stages: DataFrame) -> DataFrame: ...


def task_list(tasks: DataFrame, status: str | None = None, module: str | None = None, since: Column | None = None, until: Column | None = None, limit: int | None = 20) -> DataFrame:
    """The most recent tasks first, of the filters that are given; limit is the page that is shown. All of them (limit None) come as
    they are: nothing is sorted that no page shows."""
    for cond in (status and F.col("status") == status, module and F.col("module") == module, None if since is None else F.col("started_at") >= since, None if until is None else F.col("started_at") < until):
        tasks = tasks if cond is None else tasks.where(cond)
    return tasks if limit is None else tasks.orderBy(F.desc("started_at"), "task_id").limit(limit)


def task_show(tasks: DataFrame, stages: DataFrame) -> DataFrame:
    """Who, when, what, on which object, with which result: a row for each stage; a task without stages has one. A task's
    stages are together and in their order; tasks are in none."""
    who = tasks.select("task_id", F.col("actor").alias("who"), F.col("started_at").alias("at"), F.col("operation").alias("action"), F.col("module").alias("object"), F.col("status").alias("result"))
    own = stages.select("task_id", "actual_seq", "stage_key", F.col("status").alias("stage_status"), seconds(F.col("started_at"), F.col("ended_at")).alias("seconds"))
    return who.join(own, "task_id", "left").repartition("task_id").sortWithinPartitions("task_id", F.col("actual_seq").asc_nulls_first())


def task_funnel(stages: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each task, with the output of each of the stages named."""
    return stages.groupBy("task_id").pivot("stage_key", keys).agg(F.sum("output"))


def as_json(view: DataFrame) -> DataFrame:
    """The rows of a view as JSON, nulls kept."""
    return view.select(F.to_json(F.struct(*view.columns), {"ignoreNullFields": "false"}).alias("json"))


def resolve(stages: DataFrame, resolvers: dict[str, DetailResolver | Callable[[DataFrame], DataFrame]]) -> dict[str, DataFrame]:
    """Details by module, from each module's own resolver."""
    return {name: (r if callable(r) else r.details)(stages.where(F.col("module") == name)) for name, r in resolvers.items()}
