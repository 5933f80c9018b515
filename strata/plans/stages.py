"""raw -> store -> quality -> publish -> analysis, each stage from written tables.

Every table of a run is published as a new version of itself: readers see the version
before until the new one is whole, also when the run dies in between.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.contracts import RunPlan, StagedQuestion
from strata.operators.conform import conform_with_text, text_columns
from strata.operators.measures import Measure
from strata.operators.quality import (
    REPORT_SCHEMA,
    duplicate_keys,
    exceeded,
    key_report,
    rule_measures,
    rule_rows,
    store_measures,
    union_report,
)
from strata.sources import (
    LayerTable,
    export_csv,
    layer_path,
    publish_layer,
    row_hash,
    scan_delimited,
    scan_drifting,
)

MALFORMED = "MalformedLine"
T = TypeVar("T")


class LimitExceeded(RuntimeError):
    """A run's checks found more than its plan allows; ``breaches`` are those report rows."""

    def __init__(self, breaches: list):
        self.breaches = breaches
        listed = ", ".join(
            f"{b.table} {b.check} {b.column or ''} {b.metric}: {b.value} > {b.at_most}" for b in breaches
        )
        super().__init__(f"nothing was published: {listed}")


@dataclass(frozen=True)
class RunResult:
    """The tables of a run by layer; ``analysis`` frames read the answers' layers in order."""

    raw: Mapping[str, LayerTable]
    store: Mapping[str, LayerTable]
    quality: LayerTable
    violations: Mapping[str, LayerTable]
    publish: Mapping[str, LayerTable]
    analysis: Mapping[str, DataFrame]


def together(spark: SparkSession, jobs: Mapping[str, Callable[[], T]]) -> dict[str, T]:
    """Submit independent jobs at once, so small tables do not wait for large ones.

    Each thread gets its own copy of the caller's job group, pool and tags.
    """
    with ThreadPoolExecutor(max_workers=max(len(jobs), 1)) as pool:
        submitted = {
            name: pool.submit(inheritable_thread_target(spark)(job)) for name, job in jobs.items()
        }
        return {name: future.result() for name, future in submitted.items()}


def _scan_measures() -> list[Measure]:
    return [
        Measure("scan", None, "malformed_lines", F.count_if(F.col(MALFORMED).isNotNull())),
    ]


def _named(measures: list[Measure]) -> dict[str, Column]:
    return {m.name: m.value for m in measures}


def _observed(name: str, layer: str, measures: list[Measure], table: LayerTable) -> list[tuple]:
    """Report rows of what was counted while a table was written, its rows included."""
    found = [(name, m.check, m.column, m.metric, table.metrics[m.name]) for m in measures]
    return [(name, "layer", layer, "rows", table.rows), *found]


def load_raw(
    spark: SparkSession,
    plan: RunPlan,
    inputs: Mapping[str, str],
    output: str,
    multi_line: bool = False,
    drifting: bool = False,
) -> dict[str, LayerTable]:
    """Every extract as delivered, all text, plus the full text of malformed lines.

    Files of one extract must have one header, or with ``drifting`` are united by name."""
    scan = scan_drifting if drifting else scan_delimited

    def load(name: str) -> LayerTable:
        scanned = scan(spark, inputs[name], corrupt_column=MALFORMED, multi_line=multi_line)
        return publish_layer(scanned, layer_path(output, "raw", name), _named(_scan_measures()))

    return together(spark, {c.name: lambda n=c.name: load(n) for c in plan.contracts})


def build_store(plan: RunPlan, raw: Mapping[str, DataFrame], output: str) -> dict[str, LayerTable]:
    """Typed tables. Null profile, cast audit and rule counts come from the same pass."""

    def build(name: str) -> LayerTable:
        contract = plan.contract(name)
        return publish_layer(
            conform_with_text(raw[name], contract),
            layer_path(output, "store", name),
            _named(store_measures(contract, plan.rules, plan.audit_values)),
            drop=text_columns(contract),
        )

    spark = next(iter(raw.values())).sparkSession
    return together(spark, {c.name: lambda n=c.name: build(n) for c in plan.contracts})


def report_quality(
    spark: SparkSession,
    plan: RunPlan,
    raw: Mapping[str, LayerTable],
    store: Mapping[str, LayerTable],
    output: str,
) -> tuple[LayerTable, dict[str, LayerTable]]:
    """What was counted up to here, and the keys of the rows that break a rule."""
    frames = {name: table.frame for name, table in store.items()}
    observed = []  # a few numbers per column, known since the tables were written
    for contract in plan.contracts:
        name = contract.name
        observed += _observed(name, "raw", _scan_measures(), raw[name])
        measures = store_measures(contract, plan.rules, plan.audit_values)
        observed += _observed(name, "store", measures, store[name])
    known = spark.createDataFrame(observed, REPORT_SCHEMA).coalesce(1)
    report = union_report([known, *key_report(frames, plan.contracts, plan.foreign_keys)])
    lists = {
        rule.name: rule_rows(frames[rule.table], rule) for rule in plan.rules if rule.list_by
    }
    for name, table in plan.duplicate_lists.items():
        lists[name] = duplicate_keys(frames[table], plan.contract(table).primary_key)

    def write(name: str, frame: DataFrame) -> Callable[[], LayerTable]:
        return lambda: publish_layer(frame, layer_path(output, "quality", name), in_order=name in lists)

    written = together(spark, {n: write(n, f) for n, f in {"checks": report, **lists}.items()})
    return written.pop("checks"), written


def hold_to_limits(plan: RunPlan, checks: DataFrame) -> None:
    """Raise where the checks found more than the plan's limits allow.

    The report has a few rows for each column of the run's tables, and that many
    breaches at most.
    """
    breaches = exceeded(checks, plan.limits).collect() if plan.limits else []
    if breaches:
        raise LimitExceeded(breaches)


def _publish_measures(plan: RunPlan, name: str) -> list[Measure]:
    return rule_measures([rule for rule in plan.publish_rules if rule.table == name])


def build_publish(
    plan: RunPlan, store: Mapping[str, DataFrame], output: str
) -> dict[str, LayerTable]:
    """The published tables, built side by side."""

    def build(name: str) -> LayerTable:
        measures = _named(_publish_measures(plan, name))
        return publish_layer(plan.publish[name](store), layer_path(output, "publish", name), measures)

    spark = next(iter(store.values())).sparkSession
    return together(spark, {name: lambda n=name: build(n) for name in plan.publish})


def report_publish(
    spark: SparkSession,
    plan: RunPlan,
    checks: LayerTable,
    publish: Mapping[str, LayerTable],
    output: str,
) -> LayerTable:
    """The whole report: the checks, and what was counted while the published tables were
    written. It becomes visible at once, as one version."""
    rows = [
        row
        for name, table in publish.items()
        for row in _observed(name, "publish", _publish_measures(plan, name), table)
    ]
    added = spark.createDataFrame(rows, REPORT_SCHEMA).coalesce(1)
    whole = union_report([checks.frame, added])
    return publish_layer(whole, layer_path(output, "quality", "report"))


def analyse(
    plan: RunPlan, publish: Mapping[str, DataFrame], output: str | None = None
) -> dict[str, DataFrame]:
    """Every question's answer.

    With an output folder each is computed once and kept as a layer in its order,
    which is what is returned. The CSV beside it is written from the layer, and read
    once more to make sure that it holds the same rows. Figures of a staged question
    are a layer of their own.
    """
    if output is None or not plan.questions:
        return {name: question(publish) for name, question in plan.questions.items()}
    root = output.rstrip("/")

    def keep(name: str) -> DataFrame:
        question = plan.questions[name]
        if isinstance(question, StagedQuestion):
            figures = question.figures(publish)
            stored = publish_layer(figures, layer_path(output, "analysis", f"{name}_figures"))
            answer = question.answer(stored.frame)
        else:
            answer = question(publish)
        hashed = {"row_hash": row_hash(answer)}
        table = publish_layer(answer, layer_path(output, "analysis", name), hashed, in_order=True)
        export_csv(table.frame, f"{root}/analysis/{name}", verify=table.metrics["row_hash"])
        return table.frame

    spark = next(iter(publish.values())).sparkSession
    return together(spark, {name: lambda n=name: keep(n) for name in plan.questions})


def run(
    spark: SparkSession,
    plan: RunPlan,
    inputs: Mapping[str, str],
    output: str,
    multi_line: bool = False,
    drifting: bool = False,
) -> RunResult:
    """Run every stage of a plan. ``inputs`` maps each of its tables to its files.

    Repeating a run makes a new version of all of its tables. Where the checks break
    a limit of the plan, ``LimitExceeded`` ends the run: raw, store and checks are
    new, published tables, answers and the report are those of the run before.
    """
    missing = [c.name for c in plan.contracts if c.name not in inputs]
    if missing:
        raise ValueError(f"no input given for {missing}")
    raw = load_raw(spark, plan, inputs, output, multi_line, drifting)
    store = build_store(plan, {n: t.frame for n, t in raw.items()}, output)
    checks, violations = report_quality(spark, plan, raw, store, output)
    hold_to_limits(plan, checks.frame)
    publish = build_publish(plan, {n: t.frame for n, t in store.items()}, output)
    report = report_publish(spark, plan, checks, publish, output)
    analysis = analyse(plan, {n: t.frame for n, t in publish.items()}, output)
    return RunResult(raw, store, report, violations, publish, analysis)
