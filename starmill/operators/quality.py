"""Data checks.

Each check is a plan that yields report rows ``(table_name, check_name, row_count,
violations)``; reports of many checks are unioned and run as one job.  Rows are
grouped by key before anything is joined or counted, so a key held by a third of the
rows is reduced inside the map tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from starmill.operators.lookups import DEFAULT_BUDGET, BroadcastBudget

REPORT_COLUMNS = ("table_name", "check_name", "row_count", "violations")


class QualityError(AssertionError):
    """At least one check found violations."""


@dataclass(frozen=True)
class Reference:
    """A fact column that must name a member of a dimension."""

    column: str
    dimension: DataFrame
    member: str
    measured: dict = field(default_factory=dict, compare=False, repr=False)

    def admitted(self, budget: BroadcastBudget) -> bool:
        """Whether the members may be broadcast; they are measured once per budget."""
        if budget not in self.measured:
            self.measured[budget] = budget.admits(self.members())
        return self.measured[budget]

    def members(self) -> DataFrame:
        """The dimension's keys as text, the form in which keys are compared."""
        return self.dimension.select(F.col(self.member).cast("string").alias("value"))


def _total(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0))


def report_line(table: str, check: str, rows: Column, violations: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_name"),
        rows.cast("long").alias("row_count"),
        violations.cast("long").alias("violations"),
    )


def report_rows(df: DataFrame, *lines: Column) -> DataFrame:
    return df.select(F.inline(F.array(*lines)))


def key_report(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Grain and key nullity in one pass: rows beyond one per key, rows with a NULL key part.

    A NULL counts as one key value, as SELECT DISTINCT has it.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    totals = per_key.agg(
        _total(F.col("copies")).alias("rows"),
        _total(F.col("copies") - 1).alias("extra"),
        _total(F.when(missing, F.col("copies")).otherwise(0)).alias("missing"),
    )
    name = ",".join(keys)
    return report_rows(
        totals,
        report_line(table, f"unique({name})", F.col("rows"), F.col("extra")),
        report_line(table, f"not_null({name})", F.col("rows"), F.col("missing")),
    )


def reference_report(
    fact: DataFrame,
    table: str,
    references: Sequence[Reference],
    budget: BroadcastBudget = DEFAULT_BUDGET,
) -> DataFrame:
    """Fact rows per reference that name no member; a NULL reference is such a row.

    Dimensions whose keys fit the budget are probed together in one scan without
    moving the fact.  For the others the fact's keys are counted first and the join
    runs on those counts, whatever the skew.
    """
    small = [r for r in references if r.admitted(budget)]
    large = [r for r in references if r not in small]
    reports = []
    if small:
        reports.append(_probed(fact, table, small))
    if large:
        reports.append(_counted(fact, table, large))
    return combined(*reports)


def _probed(fact: DataFrame, table: str, references: Sequence[Reference]) -> DataFrame:
    keys = [F.col(r.column).cast("string").alias(f"key{i}") for i, r in enumerate(references)]
    probed = fact.select(*keys)
    for i, r in enumerate(references):
        members = r.members().distinct().select(F.col("value").alias(f"key{i}"), F.lit(True).alias(f"known{i}"))
        probed = probed.join(F.broadcast(members), f"key{i}", "left")
    totals = probed.agg(
        F.count(F.lit(1)).alias("rows"),
        *[_total(F.col(f"known{i}").isNull().cast("long")).alias(f"orphans{i}") for i in range(len(references))],
    )
    return report_rows(
        totals,
        *[
            report_line(table, f"references({r.column})", F.col("rows"), F.col(f"orphans{i}"))
            for i, r in enumerate(references)
        ],
    )


def _counted(fact: DataFrame, table: str, references: Sequence[Reference]) -> DataFrame:
    pairs = [
        F.struct(F.lit(r.column).alias("reference"), F.col(r.column).cast("string").alias("value"))
        for r in references
    ]
    used = (
        fact.select(F.inline(F.array(*pairs)))
        .groupBy("reference", "value")
        .agg(F.count(F.lit(1)).alias("uses"))
    )
    members = reduce(
        DataFrame.unionByName,
        [r.members().withColumn("reference", F.lit(r.column)) for r in references],
    ).distinct()
    resolved = used.join(members.withColumn("known", F.lit(True)), ["reference", "value"], "left")
    # Conditional sums, so that an empty fact still reports every reference.
    sums = []
    for i, r in enumerate(references):
        mine = F.col("reference") == r.column
        sums.append(_total(F.when(mine, F.col("uses"))).alias(f"rows{i}"))
        sums.append(_total(F.when(mine & F.col("known").isNull(), F.col("uses"))).alias(f"orphans{i}"))
    return report_rows(
        resolved.agg(*sums),
        *[
            report_line(table, f"references({r.column})", F.col(f"rows{i}"), F.col(f"orphans{i}"))
            for i, r in enumerate(references)
        ],
    )


def parse_totals(table: str, parsers: Mapping[str, Column]) -> tuple[list[Column], list[Column]]:
    """Aggregates that count non-blank values without a parsed form, and report lines made of them."""
    failed = {
        name: _total((F.col(name).isNotNull() & (F.trim(F.col(name)) != "") & parsed.isNull()).cast("long"))
        for name, parsed in parsers.items()
    }
    totals = [F.count(F.lit(1)).alias("rows"), *[v.alias(f"failed_{n}") for n, v in failed.items()]]
    return totals, [report_line(table, f"parses({n})", F.col("rows"), F.col(f"failed_{n}")) for n in parsers]


def parse_report(raw: DataFrame, table: str, parsers: Mapping[str, Column]) -> DataFrame:
    """Non-blank source values whose parsed form is NULL, per column, in one pass."""
    totals, lines = parse_totals(table, parsers)
    return report_rows(raw.agg(*totals), *lines)


def exact_totals(table: str, exact: Mapping[str, Column]) -> tuple[list[Column], list[Column]]:
    """Aggregates that count parsed values which are not ``exact``, and report lines made of them."""
    totals = [_total((~value).cast("long")).alias(f"rounded_{name}") for name, value in exact.items()]
    return totals, [report_line(table, f"parses_exactly({n})", F.col("rows"), F.col(f"rounded_{n}")) for n in exact]


def exact_report(raw: DataFrame, table: str, exact: Mapping[str, Column]) -> DataFrame:
    """Source values that are rounded before anything is computed with them, per column, in one pass."""
    totals, lines = exact_totals(table, exact)
    return report_rows(raw.agg(F.count(F.lit(1)).alias("rows"), *totals), *lines)


def _exact(df: DataFrame, measure: str) -> Column:
    """The measure as a decimal: at its own scale, or a double at ten places."""
    kind = df.schema[measure].dataType
    scale = kind.scale if isinstance(kind, T.DecimalType) else 10
    return F.col(measure).try_cast(f"decimal(38,{scale})")


def reconciliation(before: DataFrame, after: DataFrame, measure: str) -> DataFrame:
    """One row: row counts, exact measure totals, and how many amounts the totals leave out.

    Left out are NULLs and what no decimal of 38 digits holds, so a loss cannot hide there.
    """
    side = [
        df.select(F.lit(label).alias("side"), _exact(df, measure).alias("amount"))
        for label, df in (("before", before), ("after", after))
    ]
    totals = []
    for label in ("before", "after"):
        mine = F.col("side") == label
        totals.append(F.count(F.when(mine, F.lit(1))).alias(f"rows_{label}"))
        totals.append(_total(F.when(mine, F.col("amount"))).alias(f"{measure}_{label}"))
        totals.append(F.count(F.when(mine & F.col("amount").isNull(), F.lit(1))).alias(f"absent_{label}"))
    return side[0].unionByName(side[1]).agg(*totals)


def reconciliation_report(before: DataFrame, after: DataFrame, table: str, measure: str) -> DataFrame:
    """The reconciliation as report rows: rows lost or added, a total that moved (one violation,
    however little), and amounts that became absent or appeared."""
    totals = reconciliation(before, after, measure)
    moved = ~F.col(f"{measure}_after").eqNullSafe(F.col(f"{measure}_before"))
    absent = F.abs(F.col("absent_after") - F.col("absent_before"))
    return report_rows(
        totals,
        report_line(table, "keeps(rows)", F.col("rows_after"), F.abs(F.col("rows_after") - F.col("rows_before"))),
        report_line(table, f"keeps({measure})", F.col("rows_after"), absent + moved.cast("int")),
    )


def held_report(df: DataFrame, table: str, held: Column, what: str) -> DataFrame:
    """Rows for which ``held`` is false."""
    totals = df.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(~held, F.lit(1))).alias("lost"))
    return report_rows(totals, report_line(table, f"holds({what})", F.col("rows"), F.col("lost")))


def combined(*reports: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def enforce(report: DataFrame) -> list:
    """Run the report once; raise when a check failed.  Its size is the number of checks."""
    lines = report.collect()
    failures = [line for line in lines if line["violations"]]
    if failures:
        raise QualityError(
            "; ".join(f"{f['table_name']}: {f['check_name']} has {f['violations']} violations" for f in failures)
        )
    return lines
