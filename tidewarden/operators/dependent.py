"""Dependent quantities: a sensor takes over the flag or is judged by the value of another one at the same time.

Rules are a small table. All rules of a layer are matched by one nearest-in-time join that gives flag and value together,
and the state (row, flag) of the series that rules name is written between layers: the table is read a fixed number of
times a layer, however many rules there are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import flags
from ..functions.durations import to_micros
from ..storage import materialise
from . import checks
from .joins import combine_max, nearest_in_time


@dataclass(frozen=True)
class Rule:
    """An independent series, those that depend on it, and how."""

    independent: int
    dependent: tuple[int, ...]
    tolerance: str = "0.5s"
    range: tuple[float, float] | None = None
    stabilisation: str | None = None
    max_downtime: str | None = None
    flag_when_missing: int | None = flags.BAD

    @staticmethod
    def ids(dependent: int | str | list[int]) -> tuple[int, ...]:
        """One id, a list, or a text of ids with commas."""
        if isinstance(dependent, int):
            return (dependent,)
        return tuple(int(x) for x in (dependent.split(",") if isinstance(dependent, str) else dependent))


RULES = "rule int, independent long, dependent long, tolerance long, low double, high double, missing int"


def rule_table(df: DataFrame, rules: list[tuple[int, Rule]]) -> DataFrame:
    """One row for each rule and dependent series; as long as the settings."""
    rows = [
        (i, r.independent, d, max(1, to_micros(r.tolerance)), *(map(float, r.range) if r.range else (None, None)), flags.NO_QC if r.flag_when_missing is None else r.flag_when_missing)
        for i, r in rules
        for d in dict.fromkeys(r.dependent)
    ]
    return df.sparkSession.createDataFrame(rows, RULES)


def matched(df: DataFrame, rules: list[tuple[int, Rule]], key: str, within: list[str], own: DataFrame | None = None) -> DataFrame:
    """The dependent rows of all rules, once for each rule, each with its independent row as ``near`` (qc_flag, result).

    own: (rule, iot_id, own_flag), flags that an independent row has for one rule beside those of the table.
    """
    table = rule_table(df, rules)
    left = df.select("iot_id", "t", *within, F.col(key).alias("dependent")).join(F.broadcast(table.drop("independent")), "dependent")
    right = df.select("iot_id", "t", *within, F.col(key).alias("independent"), "qc_flag", "result")
    right = right.join(F.broadcast(table.select("rule", "independent", "tolerance").distinct()), "independent")
    if own is not None:
        right = right.join(own, ["rule", "iot_id"], "left").withColumn("qc_flag", flags.merge("qc_flag", "own_flag")).drop("own_flag")
    return nearest_in_time(left, right, ["rule", *within], F.col("tolerance"), ["qc_flag", "result"])


def taken_over() -> Column:
    """The independent flag if it is neither NO_QC nor GOOD, and the rule's flag where no independent row is near."""
    copied = F.when(F.col("near.qc_flag").isin(flags.NO_QC, flags.GOOD), F.lit(flags.NO_QC)).otherwise(F.col("near.qc_flag"))
    return F.when(F.col("near").isNull(), F.col("missing")).otherwise(copied)


def judged() -> Column:
    """BAD where the independent value near by is outside the rule's range (bounds are inside)."""
    bad = (F.col("near.result") < F.col("low")) | (F.col("near.result") > F.col("high"))
    return F.when(F.coalesce(bad, F.lit(False)), F.lit(flags.BAD)).otherwise(F.lit(flags.NO_QC))


def base(df: DataFrame, rule: Rule, key: str = "datastream_id", within: list[str] | None = None) -> DataFrame:
    """(iot_id, qc_flag) for the dependent rows by the flag of the independent one."""
    return matched(df, [(0, rule)], key, within or []).select("iot_id", taken_over().alias("qc_flag"))


def secondary(df: DataFrame, rule: Rule, key: str = "datastream_id", within: list[str] | None = None) -> DataFrame:
    """(iot_id, qc_flag) for the dependent rows by the value of the independent one."""
    return matched(df, [(0, rule)], key, within or []).select("iot_id", judged().alias("qc_flag"))


def layers(rules: list[Rule]) -> list[list[Rule]]:
    """The rules in order, cut so that no rule of a layer reads what an earlier one of it writes."""
    out: list[list[Rule]] = []
    for rule in rules:
        if not out or any(rule.independent in r.dependent for r in out[-1]):
            out.append([])
        out[-1].append(rule)
    return out


def state_of(df: DataFrame, rules: list[Rule], key: str, within: list[str]) -> DataFrame:
    """What rules read and write, of the series that they name."""
    named = sorted({i for r in rules for i in (r.independent, *r.dependent)})
    return df.where(F.col(key).isin(named)).select("iot_id", "t", "result", "qc_flag", key, *within)


def propagate(state: DataFrame, rules: list[Rule], key: str, within: list[str], own: DataFrame | None = None) -> DataFrame:
    """The state after all rules in list order; a layer's flags are made from one state and merged at once.

    own: see ``matched``; the number of a rule is its place in the list.
    """
    numbered, done = iter(enumerate(rules)), layers(rules)
    for n, layer in enumerate(done):
        here = [next(numbered) for _ in layer]
        found = matched(state, here, key, within, own).select("iot_id", flags.merge(taken_over(), judged()).alias("qc_flag"))
        state = combine_max(state, found)
        if n + 1 < len(done):
            state = materialise(state, "state")
    return state


def apply_rules(df: DataFrame, rules: list[Rule], key: str = "datastream_id", within: list[str] | None = None) -> DataFrame:
    """df with the flags of all rules in list order. Evaluates df once and writes it into the shared folder."""
    if not rules:
        return df
    df, within = materialise(df, "observations"), within or []
    return combine_max(df, propagate(state_of(df, rules, key, within), rules, key, within).select("iot_id", "qc_flag"))


def stabilised(df: DataFrame, rules: list[Rule], key: str = "datastream_id", within: list[str] | None = None) -> DataFrame:
    """df with the flags of independent series that haven't been up for long enough, and of the series that depend on them.

    Rules count in list order: a later rule of the same independent series adds to what its own dependent series take over,
    not to those of earlier rules. All independent series go through one window pass. Rules without a stabilisation time or
    a range are passed over. Evaluates df once and writes it.
    """
    rules = [r for r in rules if r.stabilisation and r.range]
    if not rules:
        return df
    df, within = materialise(df, "observations"), within or []
    # (rule that reads, rule that flags): a rule reads the flags of its own and of earlier rules of its independent series.
    rows = [
        (i, j, q.independent, *map(float, q.range), to_micros(q.max_downtime or 0), to_micros(q.stabilisation))
        for i, r in enumerate(rules)
        for j, q in enumerate(rules[: i + 1])
        if q.independent == r.independent
    ]
    table = df.sparkSession.createDataFrame(rows, f"rule int, by int, {key} long, low double, high double, max_downtime long, dt_stabilization long")
    one = df.where(F.col(key).isin(sorted({r.independent for r in rules}))).select("iot_id", "t", "result", key, *within).join(F.broadcast(table), key)
    flagged = checks.with_stabilisation(one, "rule", "by", *dict.fromkeys([*within, key]))
    own = materialise(flagged.groupBy("rule", "iot_id").agg(F.max("stabilisation_flag").alias("own_flag")), "stabilisation")
    quiet = [Rule(r.independent, r.dependent, r.tolerance, flag_when_missing=None) for r in rules]
    state = propagate(state_of(df, rules, key, within), quiet, key, within, own)
    return combine_max(df, state.select("iot_id", "qc_flag").unionByName(own.select("iot_id", F.col("own_flag").alias("qc_flag"))))
