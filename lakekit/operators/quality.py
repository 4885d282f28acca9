"""Named expectations over rows: warn, drop or fail; quarantine and gate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lakekit.values import QUARANTINE_LIMIT

Rules = Mapping[str, Column]


def holds(rule: Column) -> Column:
    """A rule holds if it is true; NULL counts as broken."""
    return F.coalesce(rule, F.lit(False))


def _rule_counts(rules: Rules) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"), *[F.count_if(~holds(r)).alias(name) for name, r in rules.items()]]


def expect_warn(df: DataFrame, rules: Rules, observation: Observation | None = None) -> DataFrame:
    """All rows stay, with the names of the rules they break in `warnings`.

    With an observation, broken rules are also counted while the rows pass through, without another run.
    """
    counted = df.observe(observation, *_rule_counts(rules)) if observation else df
    return with_failed_rules(counted, rules, "warnings")


def expect_drop(df: DataFrame, rules: Rules, observation: Observation | None = None) -> DataFrame:
    """Rows that break a rule are removed, and counted on the side if asked for."""
    counted = df.observe(observation, *_rule_counts(rules)) if observation else df
    return counted.where(reduce(lambda a, b: a & b, (holds(r) for r in rules.values())))


def expect_fail(df: DataFrame, rules: Rules) -> DataFrame:
    """The job stops at a row that breaks a rule, naming the first rule it breaks."""
    passed = F.lit(True)
    for name, rule in reversed(list(rules.items())):
        stop = F.raise_error(F.lit(f"expectation failed: {name}")).cast("boolean")
        passed = F.when(holds(rule), passed).otherwise(stop)
    return df.where(passed)


def expectation_metrics(df: DataFrame, rules: Rules) -> DataFrame:
    """Passed and failed rows of every rule, from one pass over the table."""
    failed = df.agg(*_rule_counts(rules))
    pairs = F.array(
        *[F.struct(F.lit(name).alias("rule"), F.col(name).alias("failed")) for name in rules]
    )
    return failed.select("rows", F.inline(pairs)).select(
        "rule", (F.col("rows") - F.col("failed")).alias("passed"), "failed"
    )


def with_failed_rules(df: DataFrame, rules: Rules, name: str = "failed_rules") -> DataFrame:
    """Rows with the names of the rules they break."""
    broken = [F.when(~holds(rule), F.lit(rule_name)) for rule_name, rule in rules.items()]
    return df.withColumn(name, F.array_compact(F.array(*broken)))


def quarantine_split(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their failed rules)."""
    tagged = with_failed_rules(df, rules)
    clean = F.size("failed_rules") == 0
    return tagged.where(clean).drop("failed_rules"), tagged.where(~clean)


class QualityGateError(RuntimeError):
    """Too many rows are in quarantine."""


def quality_gate(rejected: DataFrame, limit: int = QUARANTINE_LIMIT) -> int:
    """Stop the job if more rows than the limit were rejected; otherwise return how many."""
    found = rejected.count()
    if found > limit:
        raise QualityGateError(f"{found} rows in quarantine, limit {limit}: check the source")
    return found


def gate_report(df: DataFrame, rules: Rules, limits: Sequence[int]) -> DataFrame:
    """Rejected rows of a table and whether each limit would let it pass."""
    all_hold = reduce(lambda a, b: a & b, (holds(r) for r in rules.values()))
    verdicts = F.array(*[F.lit(limit) for limit in limits])
    return df.agg(F.count_if(~all_hold).alias("rejected_rows")).select(
        "rejected_rows", F.explode(verdicts).alias("row_limit")
    ).withColumn("passes", F.col("rejected_rows") <= F.col("row_limit"))
