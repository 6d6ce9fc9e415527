"""Row expectations with a quarantine that explains every rejected row.

A NULL predicate counts as a violation, so clean rows plus quarantined rows always
equal the input.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

REASON = "dq_reason"


@dataclass(frozen=True)
class Rule:
    """``predicate`` is the condition a good row meets."""

    name: str
    predicate: str
    action: str = "drop"
    reason: str | None = None

    @property
    def label(self) -> str:
        return self.reason or self.name

    def passed(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def drop_rules(rules: list[Rule]) -> list[Rule]:
    return [r for r in rules if r.action == "drop"]


def tag(df: DataFrame, rules: list[Rule], first: list[tuple[Column, str]] | None = None) -> DataFrame:
    """Add the first failing rule's reason (NULL for a clean row).

    ``first`` holds (condition, reason) pairs that take precedence over the rules.
    """
    arms = [F.when(c, F.lit(label)) for c, label in (first or [])]
    arms += [F.when(~r.passed(), F.lit(r.label)) for r in drop_rules(rules)]
    return df.withColumn(REASON, F.coalesce(*arms) if arms else F.lit(None).cast("string"))


def accepted(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(REASON).isNull()).drop(REASON)


def rejected(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(REASON).isNotNull())


def as_received(tagged: DataFrame, raw: str = "_raw") -> DataFrame:
    """Rejected rows with the values and lineage they arrived with, and the reason."""
    return rejected(tagged).select(f"{raw}.*", REASON)


def quarantine(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """(clean, rejected-with-reason)."""
    tagged = tag(df, rules)
    return accepted(tagged), rejected(tagged)


def keep_valid(df: DataFrame, rules: list[Rule]) -> DataFrame:
    for r in drop_rules(rules):
        df = df.where(r.passed())
    return df


def rule_metrics(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Passed and failed row counts per rule, from one pass over the data."""
    sums = [F.sum(r.passed().cast("long")).alias(f"p{i}") for i, r in enumerate(rules)]
    wide = df.agg(F.count(F.lit(1)).alias("n"), *sums)
    entry = F.array(*[
        F.struct(
            F.lit(r.name).alias("rule"),
            F.lit(r.action).alias("action"),
            F.coalesce(F.col(f"p{i}"), F.lit(0)).alias("passed_rows"),
            (F.col("n") - F.coalesce(F.col(f"p{i}"), F.lit(0))).alias("failed_rows"),
        )
        for i, r in enumerate(rules)
    ])
    return wide.select(F.inline(entry))


class Counted:
    """Passed and failed rows of each rule, observed by whatever job reads the frame first; no scan of their own.

    The counts stand above the last shuffle of a frame, so a task that is run again does not count twice.
    """

    def __init__(self, rules: list[Rule]):
        self.rules, self.seen = rules, Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        passed = [F.count(F.when(r.passed(), 1)).alias(f"p{i}") for i, r in enumerate(self.rules)]
        return df.observe(self.seen, F.count(F.lit(1)).alias("n"), *passed)

    def rows(self) -> list[tuple[str, str, int, int]]:
        """(rule, action, passed_rows, failed_rows) once the job is over."""
        got = self.seen.get
        return [(r.name, r.action, got[f"p{i}"], got["n"] - got[f"p{i}"]) for i, r in enumerate(self.rules)]


METRICS = "rule string, action string, passed_rows long, failed_rows long"


def write_split(tagged: DataFrame, good_path: str, bad_path: str, mode: str = "append") -> None:
    """Write both outputs of a tagged frame; it is cached so the source is read once."""
    tagged = tagged.persist()
    try:
        accepted(tagged).write.mode(mode).parquet(good_path)
        rejected(tagged).write.mode(mode).parquet(bad_path)
    finally:
        tagged.unpersist()
