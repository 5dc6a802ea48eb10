"""Run a spec: every task becomes a lazy view named by its id, one Spark plan per sink.

There is no scheduler here. Tasks are wired in dependency order; only sinks, gates
and staged outputs start jobs.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from weftline.functions import sqlnames
from weftline.operators import quality
from weftline.operators.aggregate import aggregate, stack
from weftline.operators.clean import clean, decimals_to_double
from weftline.operators.code import run_callable
from weftline.operators.jsonflat import Options, find_json_column, flatten_json
from weftline.operators.staging import Stage
from weftline.plans.spec import PlanSpec, SpecError, TaskSpec, order_tasks
from weftline.sinks.registry import write_many
from weftline.sources.registry import read_source

log = logging.getLogger(__name__)


@dataclass
class RunResult:
    frames: dict[str, DataFrame] = field(default_factory=dict)
    writes: dict[str, dict] = field(default_factory=dict)
    quality: dict[str, DataFrame] = field(default_factory=dict)
    status: dict[str, str] = field(default_factory=dict)
    staged: list[str] = field(default_factory=list)


@dataclass
class Runner:
    """`connections` maps a connection id to its settings (path, url, fetch, send, ...).

    `functions` maps names used in specs to callables `(inputs, context) -> DataFrame`.
    With `drop_staged`, staged outputs are deleted after the last load of a run.
    """

    spark: SparkSession
    connections: dict[str, dict] = field(default_factory=dict)
    functions: dict[str, object] = field(default_factory=dict)
    stage: Stage | None = None
    fail_on_quality: bool = False
    drop_staged: bool = False

    def __post_init__(self):
        sqlnames.register(self.spark)

    def run(self, plan: PlanSpec, run_date: datetime, sources: dict[str, DataFrame] | None = None) -> RunResult:
        """`sources` supplies tables for extract tasks by task id, in place of their connection."""
        result = RunResult()
        context = {"ds": run_date.strftime("%Y-%m-%d"), "ts": run_date.isoformat(), "execution_date": run_date,
                   "dag_id": plan.dag_id, "spark": self.spark}
        for task in order_tasks(plan):
            failed = [d for d in task.depends_on or [] if result.status.get(d) == "failed"]
            if failed and task.operator_type != "load":
                result.status[task.task_id] = "skipped"
                continue
            try:
                self._run_task(plan, task, context, sources or {}, result)
                result.status[task.task_id] = "success"
            except quality.QualityGateError:
                raise
            except Exception as problem:
                result.status[task.task_id] = "failed"
                if task.trigger_rule == "all_success":
                    raise
                log.warning("task %s failed: %s", task.task_id, problem)
        if self.stage is not None and self.drop_staged:
            for task_id in result.staged:
                self.stage.drop(plan.dag_id, task_id, run_date)
        return result

    def _run_task(self, plan, task: TaskSpec, context, sources, result: RunResult) -> None:
        kind = task.operator_type
        if kind in ("dummy", "sensor"):
            return
        context = {**context, "task_id": task.task_id, **(task.custom_params or {})}
        inputs = {i: result.frames[i] for i in task.inputs if i in result.frames}
        if kind == "extract":
            df = sources.get(task.task_id)
            df = df if df is not None else read_source(self.spark, task.source, self.connections, context["execution_date"])
        elif kind == "transform":
            df = self._transform(task, inputs, context)
        elif kind == "load":
            df = first_non_empty(self._candidates(task, inputs, context, result))
        elif kind == "quality_check":
            self._check(plan, task, inputs, context, result)
            return
        elif kind == "custom":
            if not task.custom_function:
                return
            df = run_callable(self._function(task.custom_function), inputs, context, **(task.custom_params or {}))
        else:
            raise SpecError(f"unknown operator_type: {kind}")

        sinks = [s for s in [task.sink, *(task.sinks or [])] if s]
        if self.stage is not None and task.auto_sink and task.auto_sink_type != "none" and kind != "load":
            self.stage.put(df, plan.dag_id, task.task_id, context["execution_date"], task.auto_sink_type)
            result.staged.append(task.task_id)
            df = self.stage.get(plan.dag_id, task.task_id, context["execution_date"])
        result.frames[task.task_id] = df
        df.createOrReplaceTempView(task.task_id)
        if sinks:
            done = write_many(df, sinks, self.connections)
            result.writes[task.task_id] = done
            errors = [f"{name}: {r}" for name, r in done.items() if isinstance(r, str)]
            if len(errors) == len(sinks):
                raise RuntimeError("; ".join(errors))

    def _function(self, name):
        return self.functions.get(name, name)

    def _transform(self, task: TaskSpec, inputs: dict[str, DataFrame], context: dict) -> DataFrame:
        if task.sql_transform:
            return self.sql(task.sql_transform, inputs, context)
        if task.python_transform or task.python_script_path or task.custom_script:
            target = task.python_transform or task.python_script_path or task.custom_script
            return run_callable(self._function(target), inputs, context, **(task.custom_params or {}))
        if not inputs:
            raise SpecError(f"task {task.task_id} has no input")
        df = stack(list(inputs.values()))
        if task.json_flatten is not None:
            settings = dict(task.json_flatten)
            column = settings.pop("json_column", None) or find_json_column(df)
            return df if column is None else flatten_json(df, column, Options(**settings))
        if task.validation_rules:
            order = [F.col(c) for c in task.validation_rules.get("order_by", [])]
            return clean(df, {k: v for k, v in task.validation_rules.items() if k != "order_by"}, task.drop_invalid, order)
        if task.aggregations:
            return aggregate(df, task.group_by or [], task.aggregations)
        return df

    def sql(self, text: str, inputs: dict[str, DataFrame], context: dict) -> DataFrame:
        """SQL over inputs named by task id, with `:ds` and `:ts` as named parameters.

        `{{ ds }}` and `{{ ts }}` are accepted as another way to write them. The functions of
        `sqlnames` are known.
        """
        for name, df in inputs.items():
            decimals_to_double(df).createOrReplaceTempView(name)
        args = {}
        for key in ("ds", "ts"):
            for mark in ("'{{ %s }}'", "{{ %s }}", "'{{%s}}'", "{{%s}}"):
                text = text.replace(mark % key, f":{key}")
            if f":{key}" in text:
                args[key] = context[key]
        return self.spark.sql(text, args=args) if args else self.spark.sql(text)

    def _candidates(self, task: TaskSpec, inputs, context, result: RunResult):
        """Upstream first, but only what succeeded; then the task's own source."""
        good = [df for i, df in inputs.items() if result.status.get(i) == "success"]
        if good:
            yield stack(good)
        if task.source:
            yield read_source(self.spark, task.source, self.connections, context["execution_date"])

    def _check(self, plan: PlanSpec, task: TaskSpec, inputs, context, result: RunResult) -> None:
        rules = quality.rules_or_default(task.quality_rules, plan.global_quality_rules)
        now = context["execution_date"]
        if inputs:
            checked = quality.run_rules(stack(list(inputs.values())), rules, now)
        else:
            # The task's source is the stored target.
            table = read_source(self.spark, task.source, self.connections, now) if task.source else None
            checked = quality.check_target(self.spark, rules, now, table, fail_without_table=True)
        result.quality[task.task_id] = checked
        result.frames[task.task_id] = checked
        quality.gate(checked, self.fail_on_quality, asked=rules)


def first_non_empty(candidates) -> DataFrame:
    """The first table with a row (looks at one row only), else the first of them."""
    first = None
    for df in candidates:
        if not df.isEmpty():
            return df
        first = first if first is not None else df
    if first is None:
        raise SpecError("no data to load: neither upstream nor source is available")
    return first
