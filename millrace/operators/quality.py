"""Data-quality suites: every check becomes aggregate expressions, and a suite is one pass.

Only uniqueness needs more (a shuffle on its key): it is a scalar subquery of the same plan.
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Check:
    """A named expectation.

    ``measures`` are aggregates over the table, ``subqueries`` build single values that need
    their own grouping, and ``verdict`` turns the measured columns into
    (success, unexpected, evaluated).
    """

    name: str
    column: str
    measures: Callable[[DataFrame], dict[str, Column]]
    verdict: Callable[[Callable[[str], Column]], tuple[Column, Column, Column]]
    subqueries: Callable[[DataFrame], dict[str, Column]] = field(default=lambda df: {})
    bad: Callable[[], Column] | None = None


def _rows() -> Column:
    return F.count(F.lit(1))


def _counting(name: str, column: str, bad: Callable[[], Column]) -> Check:
    """A row-level check: no row may be ``bad``."""
    return Check(
        name, column,
        lambda df: {"bad": F.count_if(F.coalesce(bad(), F.lit(False))), "rows": _rows()},
        lambda m: (m("bad") == 0, m("bad"), m("rows")), bad=bad,
    )


def passing_rows(checks: Sequence[Check]) -> Column:
    """True for the rows that no row-level check of the suite counts as unexpected."""
    return reduce(operator.and_, [~F.coalesce(c.bad(), F.lit(False)) for c in checks if c.bad], F.lit(True))


def _measuring(name: str, column: str, value: Callable[[], Column], low, high) -> Check:
    """A table-level measure that must lie in [low, high]; an open end is ``None``."""

    def verdict(m):
        inside = F.lit(True)
        if low is not None:
            inside = inside & (m("value") >= low)
        if high is not None:
            inside = inside & (m("value") <= high)
        success = F.coalesce(inside, F.lit(False))
        return success, F.when(success, 0).otherwise(1), m("rows")

    return Check(name, column, lambda df: {"value": value(), "rows": _rows()}, verdict)


def column_exists(column: str) -> Check:
    """The column is in the schema. An empty table fails, as there is nothing to look at."""

    def measures(df):
        return {"there": F.max(F.lit(column in df.columns)), "rows": _rows()}

    return Check("expect_column_to_exist", column, measures,
                 lambda m: (F.coalesce(m("there") & (m("rows") > 0), F.lit(False)), F.when(m("there") & (m("rows") > 0), 0).otherwise(1), m("rows")))


def columns_match(expected: Sequence[str]) -> Check:
    """Exact names in exact order."""

    def measures(df):
        return {"same": F.max(F.lit(list(df.columns) == list(expected))), "rows": _rows()}

    return Check("expect_table_columns_to_match_ordered_list", "*", measures,
                 lambda m: (F.coalesce(m("same"), F.lit(False)), F.when(m("same"), 0).otherwise(1), m("rows")))


def not_null(column: str) -> Check:
    return _counting("expect_column_values_to_not_be_null", column, lambda: F.col(column).isNull())


def between(column: str, low=None, high=None) -> Check:
    """Inclusive at both ends, NULLs are not looked at, either end may be open."""

    def bad() -> Column:
        parts = ([F.col(column) < low] if low is not None else []) + ([F.col(column) > high] if high is not None else [])
        return reduce(operator.or_, parts, F.lit(False))

    return _counting("expect_column_values_to_be_between", column, bad)


def greater_than(column: str, low) -> Check:
    return _counting("greater_than", column, lambda: F.col(column) <= low)


def in_set(column: str, values: Sequence, null_policy: str = "ignore") -> Check:
    """``null_policy="ignore"`` skips NULLs, ``"reject"`` counts them as unexpected."""

    def bad() -> Column:
        outside = ~F.col(column).isin(*values)
        return outside | F.col(column).isNull() if null_policy == "reject" else outside

    return _counting("expect_column_values_to_be_in_set", column, bad)


def matches(column: str, pattern: str) -> Check:
    """The whole value matches the pattern."""
    return _counting("expect_column_values_to_match_regex", column, lambda: ~F.col(column).rlike(f"^(?:{pattern})$"))


def no_negatives(column: str) -> Check:
    return _counting("no_negative_values", column, lambda: F.col(column) < 0)


def finite(column: str) -> Check:
    """No NaN and no infinity; NULL is neither."""
    return _counting("no_nan_or_inf", column, lambda: F.isnan(column) | (F.abs(F.col(column)) == float("inf")))


def row_count_between(low: int | None = None, high: int | None = None) -> Check:
    return _measuring("expect_table_row_count_to_be_between", "*", _rows, low, high)


def mean_between(column: str, low=None, high=None) -> Check:
    return _measuring("expect_column_mean_to_be_between", column, lambda: F.avg(column), low, high)


def unique(column: str, mode: str = "extra") -> Check:
    """``extra``: values beyond the first of each are unexpected. ``members``: every row of a
    repeated value is. NULLs are not looked at."""

    def subqueries(df):
        counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        over = F.sum(F.col("n") - 1) if mode == "extra" else F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0))
        return {"bad": counts.agg(F.coalesce(over, F.lit(0)).alias("b")).scalar()}

    return Check("expect_column_values_to_be_unique", column, lambda df: {"rows": F.count(column)},
                 lambda m: (m("bad") == 0, m("bad"), m("rows")), subqueries)


def unique_share_between(column: str, low: float, high: float, approximate: bool = False) -> Check:
    """distinct / non-null in [low, high]; the sketch is opt-in."""

    def subqueries(df):
        if approximate:
            return {"distinct": df.agg(F.approx_count_distinct(column).alias("d")).scalar()}
        return {"distinct": df.agg(F.count_distinct(column).alias("d")).scalar()}

    def verdict(m):
        share = F.when(m("rows") > 0, m("distinct") / m("rows"))
        success = F.coalesce((share >= low) & (share <= high), F.lit(False))
        return success, F.when(success, 0).otherwise(1), m("rows")

    return Check("expect_column_proportion_of_unique_values_to_be_between", column, lambda df: {"rows": F.count(column)}, verdict, subqueries)


def counts_equal(name: str, condition: str, expected: int) -> Check:
    """An SQL count check: rows matching ``condition`` number exactly ``expected``."""
    return Check(name, condition, lambda df: {"n": F.count_if(F.expr(condition)), "rows": _rows()},
                 lambda m: (m("n") == expected, F.abs(m("n") - expected), m("rows")))


def run_suite(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check: (position, expectation, column_name, success, unexpected, evaluated)."""
    measures, extra = {}, {}
    for i, check in enumerate(checks):
        measures.update({f"m{i}_{k}": v for k, v in check.measures(df).items()})
        extra.update({f"m{i}_{k}": v for k, v in check.subqueries(df).items()})
    measured = df.agg(*[v.alias(k) for k, v in measures.items()])
    measured = measured.select("*", *[v.alias(k) for k, v in extra.items()])
    rows = []
    for i, check in enumerate(checks):
        success, unexpected, evaluated = check.verdict(lambda k, i=i: F.col(f"m{i}_{k}"))
        rows.append(
            F.struct(
                F.lit(i).cast("long").alias("position"), F.lit(check.name).alias("expectation"), F.lit(check.column).alias("column_name"),
                success.alias("success"), unexpected.cast("long").alias("unexpected"), evaluated.cast("long").alias("evaluated"),
            )
        )
    return measured.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def suite_summary(results: DataFrame) -> DataFrame:
    return results.agg(
        F.bool_and("success").alias("success"), F.count(F.lit(1)).alias("evaluated_expectations"),
        F.count_if("success").alias("successful_expectations"), F.count_if(~F.col("success")).alias("unsuccessful_expectations"),
    )


def quality_gate(results: DataFrame, critical: Sequence[str], floor: float = 0.8) -> DataFrame:
    """Fails when a failed check's name contains a critical name, or too few checks passed."""
    hit = reduce(operator.or_, [F.col("expectation").contains(c) for c in critical], F.lit(False))
    return results.agg(
        F.count_if(~F.col("success") & hit).alias("critical_failures"),
        F.avg(F.col("success").cast("double")).alias("success_rate"),
    ).withColumn("passed", (F.col("critical_failures") == 0) & (F.col("success_rate") >= floor))


class QualityError(ValueError):
    """A batch did not pass its suite."""


def branch(df: DataFrame, checks: Sequence[Check], quarantine_root: str, run_id: str, on_failure: str = "quarantine") -> bool:
    """True when the batch passes. Otherwise the whole batch goes to ``quarantine/<run id>``
    and the call returns False, or raises with ``on_failure="raise"``."""
    verdict = suite_summary(run_suite(df, checks)).first()
    if verdict["success"]:
        return True
    df.write.mode("overwrite").parquet(f"{quarantine_root.rstrip('/')}/quarantine/{run_id}")
    if on_failure == "raise":
        raise QualityError(f"{verdict['unsuccessful_expectations']} of {verdict['evaluated_expectations']} checks failed")
    return False


def ready(df: DataFrame, required: Sequence[str], min_rows: int = 100, max_missing: float = 0.1) -> DataFrame:
    """Enough rows, few enough missing cells overall, required columns present."""
    nulls = reduce(operator.add, [F.count_if(F.col(c).isNull()) for c in df.columns])
    lacking = [c for c in required if c not in df.columns]
    measured = df.agg(_rows().alias("rows"), nulls.alias("missing"))
    share = F.when(F.col("rows") > 0, F.col("missing") / (F.col("rows") * len(df.columns)))
    return measured.withColumn("missing_share", share).withColumn("columns_present", F.lit(not lacking)).withColumn(
        "ready", (F.col("rows") >= min_rows) & F.coalesce(F.col("missing_share") <= max_missing, F.lit(False)) & F.col("columns_present")
    )


def service_levels(values: DataFrame, limits: dict[str, float]) -> DataFrame:
    """``values`` is (name, value). A limit whose name contains "max" is a ceiling, others are floors."""
    table = F.create_map(*[F.lit(x) for k, v in limits.items() for x in (k, float(v))])
    return values.withColumn("limit", table[F.col("name")]).withColumn(
        "compliant", F.when(F.col("name").contains("max"), F.col("value") <= F.col("limit")).otherwise(F.col("value") >= F.col("limit"))
    )


def output_valid(df: DataFrame, value: str) -> DataFrame:
    """At least one row and no negative value."""
    measured = df.agg(_rows().alias("rows"), F.count_if(F.col(value) < 0).alias("negatives"))
    error = F.when(F.col("rows") == 0, "no output").when(F.col("negatives") > 0, "negative values")
    return measured.withColumn("error", error).withColumn("valid", F.col("error").isNull())


@dataclass(frozen=True)
class ColumnRule:
    type: T.DataType
    nullable: bool = False
    unique: bool = False
    checks: tuple[Callable[[str], Check], ...] = ()


class TableSchema:
    """A typed schema with per-column checks; ``validate`` reports, ``enforce`` raises."""

    def __init__(self, columns: dict[str, ColumnRule]):
        self.columns = columns

    def type_errors(self, df: DataFrame) -> list[str]:
        have = {f.name: f.dataType for f in df.schema.fields}
        missing = [f"missing column {c}" for c in self.columns if c not in have]
        return missing + [
            f"column {c}: expected {r.type.simpleString()}, got {have[c].simpleString()}"
            for c, r in self.columns.items() if c in have and have[c] != r.type
        ]

    def checks(self) -> list[Check]:
        out = []
        for c, rule in self.columns.items():
            out += [] if rule.nullable else [not_null(c)]
            out += [unique(c)] if rule.unique else []
            out += [make(c) for make in rule.checks]
        return out

    def validate(self, df: DataFrame) -> DataFrame:
        errors = self.type_errors(df)
        if errors:
            raise QualityError("; ".join(errors))
        return run_suite(df, self.checks())

    def enforce(self, df: DataFrame) -> DataFrame:
        failed = self.validate(df).filter(~F.col("success")).collect()
        if failed:
            raise QualityError("; ".join(f"{r['expectation']}({r['column_name']})" for r in failed))
        return df


def check_input(schema: TableSchema):
    """Check the first DataFrame argument against a schema before the function runs."""

    def wrap(fn):
        @wraps(fn)
        def inner(df: DataFrame, *args, **kwargs):
            return fn(schema.enforce(df), *args, **kwargs)

        return inner

    return wrap
