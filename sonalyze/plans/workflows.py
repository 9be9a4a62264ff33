"""Workflow definitions: the single source of stage order, preconditions, units and conservation rules."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFINITION = "workflow string, version int, stage_key string, expected_seq int, unit string, formula string, routes array<string>, hard boolean"


@dataclass(frozen=True)
class Stage:
    key: str
    unit: str
    #: Exclusive routes that, with the output, explain the input; reasons and metrics are none.
    routes: tuple[str, ...] = ()
    #: A rule that isn't hard is a warning where it is broken.
    hard: bool = True
    #: Two sums of input, output and routes that are equal, of another relation than input = output + routes: where a stage
    #: takes one unit and gives another, the module declares how these relate.
    relation: str | None = None

    @property
    def formula(self) -> str:
        return self.relation or f"input = output{''.join(' + ' + r for r in self.routes)}"

    def sides(self) -> list[Column]:
        """Both sides of the formula as expressions over a stage's counts; null where one that it names is missing."""
        sides = self.formula.split("=")
        names = {"input", "output", *self.routes}
        if len(sides) != 2 or not re.fullmatch(r"[\w\s+*()=-]+", self.formula) or not {*re.findall(r"[^\W\d]\w*", self.formula)} <= names:
            raise ValueError(f"{self.key}: {self.formula} names what is neither a count nor a route")
        place = lambda m: m[0] if m[0] in ("input", "output") else f"element_at(routes, '{m[0]}')"
        return [F.expr(re.sub(r"[^\W\d]\w*", place, side)).cast("long") for side in sides]


@dataclass(frozen=True)
class Workflow:
    name: str
    version: int
    stages: tuple[Stage, ...]
    #: Stage to the stages that must have succeeded before; by default the one before.
    preconditions: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def required(self, key: str) -> tuple[str, ...]:
        keys = [s.key for s in self.stages]
        at = keys.index(key)
        return self.preconditions.get(key, tuple(keys[at - 1 : at]) if at else ())

    def snapshot(self) -> str:
        """What a task that starts now stores of its workflow."""
        return json.dumps({"schema": 1, "workflow": self.name, "version": self.version, "stages": [{"key": s.key, "seq": i} for i, s in enumerate(self.stages, 1)]})


#: News ingestion, version 1. The order of the eight stages is our own choice; names and conservation rules
#: are the specified ones.
NEWS = Workflow("news", 1, (
    Stage("fetch", "item", ("updated", "skipped", "failed")), Stage("metadata_dedup", "article", ("duplicates",)), Stage("classify", "article", ("irrelevant", "uncertain")),
    Stage("fulltext", "article", ("failed", "empty")), Stage("content_dedup", "article", ("duplicates",)), Stage("cluster", "article", ("unhandled",)),
    Stage("score", "article", ("failed", "skipped")), Stage("safety", "article", ("changed",)),
))


class Registry:
    """Modules declare workflows here; no operator knows one by name."""

    def __init__(self, *workflows: Workflow):
        self._all: dict[tuple[str, int], Workflow] = {}
        for w in workflows:
            self.add(w)

    def add(self, workflow: Workflow) -> None:
        keys = [s.key for s in workflow.stages]
        if (workflow.name, workflow.version) in self._all:
            raise ValueError(f"{workflow.name} {workflow.version} is declared already")
        if len({*keys}) < len(keys) or not {p for v in workflow.preconditions.values() for p in v} | {*workflow.preconditions} <= {*keys}:
            raise ValueError(f"{workflow.name}: stages repeat, or a precondition names none")
        for s in workflow.stages:
            s.sides()  # a formula that can't be compiled is refused
        self._all[workflow.name, workflow.version] = workflow

    def check(self, stages: DataFrame) -> DataFrame:
        """stages (task_id, workflow, version, stage_key, unit, input, output, routes) with the two sides of their declared formula,
        residual, rule_id and verdict. Each declared stage of each version is compiled to expressions; nothing is joined.

        A stage that its version doesn't declare, a route that its stage doesn't, or another unit is a deviation
        (undeclared_stage, undeclared_route, mixed_units): its counts prove nothing. A missing count is incomplete, never 0. Sides
        that differ are a deviation (funnel_conservation), or a warning where the rule isn't hard; a task isn't judged by warnings.
        """
        known = [((F.col("workflow") == w.name) & (F.col("version") == w.version) & (F.col("stage_key") == s.key), s) for w in self._all.values() for s in w.stages]
        pick = lambda of, none: reduce(lambda rest, x: F.when(x[0], of(x[1])).otherwise(rest), reversed(known), none)
        declared = pick(lambda s: F.struct(F.lit(s.unit).alias("unit"), F.array(*map(F.lit, s.routes)).cast("array<string>").alias("routes"), F.lit(s.hard).alias("hard")), F.lit(None))
        sides = pick(lambda s: F.array(*s.sides()), F.lit(None).cast("array<bigint>"))
        rows = stages.withColumns({"_declared": declared, "_sides": sides})
        more = F.array_except(F.map_keys("routes"), F.col("_declared.routes"))
        residual = F.col("_sides")[0] - F.col("_sides")[1]
        rule = (
            F.when(F.col("_declared").isNull(), "undeclared_stage").when(F.size(more) > 0, "undeclared_route")
            .when(F.col("unit") != F.col("_declared.unit"), "mixed_units").when(residual != 0, "funnel_conservation")
        )
        soft = (rule == "funnel_conservation") & ~F.col("_declared.hard")
        verdict = F.when(soft, "warning").when(rule.isNotNull(), "deviation").when(residual.isNull(), "incomplete").otherwise("compliant")
        return rows.select(*stages.columns, F.col("_sides")[0].alias("left_side"), F.col("_sides")[1].alias("right_side"), residual.alias("residual"), rule.alias("rule_id"), verdict.alias("verdict"))

    def definitions(self, spark: SparkSession) -> DataFrame:
        rows = [(w.name, w.version, s.key, i, s.unit, s.formula, list(s.routes), s.hard) for w in self._all.values() for i, s in enumerate(w.stages, 1)]
        return spark.createDataFrame(rows, DEFINITION)

    def preconditions(self, spark: SparkSession) -> DataFrame:
        rows = [(w.name, w.version, s.key, p) for w in self._all.values() for s in w.stages for p in w.required(s.key)]
        return spark.createDataFrame(rows, "workflow string, version int, stage_key string, required_key string")
