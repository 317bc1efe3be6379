"""Generic data tests as Spark jobs.

Each test returns the *failing rows* as a DataFrame, with the NULL handling of the usual
warehouse test definitions:

* ``unique``           one row per duplicated non-NULL value (value, n_records)
* ``not_null``         the rows whose column is NULL
* ``accepted_values``  one row per distinct non-NULL value outside the list (value, n_records)
* ``relationships``    child rows whose non-NULL key has no parent row

``summarize`` turns many such tests into one result table (model, column_name, test,
failures, passed). No row is multiplied: not_null tests are conditional counts, accepted_values tests look at
the distinct values of few-valued columns, unique tests count by value in its own type, all with partial
aggregation first, so a hot value does not concentrate rows; relationships is a
left-anti join against the parent keys (broadcast by Spark only when the parent's size is
under the threshold, sort-merge otherwise).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def unique(df: DataFrame, column: str) -> DataFrame:
    return (df.filter(F.col(column).isNotNull())
              .groupBy(F.col(column).alias("unique_field"))
              .agg(F.count(F.lit(1)).alias("n_records"))
              .filter(F.col("n_records") > 1))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return (df.groupBy(F.col(column).alias("value_field"))
              .agg(F.count(F.lit(1)).alias("n_records"))
              .filter(F.col("value_field").isNotNull() & ~F.col("value_field").isin(list(values))))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_field: str) -> DataFrame:
    keys = (parent.select(F.col(parent_field).alias("__parent_key")).filter(F.col("__parent_key").isNotNull())
            .distinct())
    return (child.filter(F.col(column).isNotNull())
                 .join(keys, F.col(column) == F.col("__parent_key"), "left_anti"))


@dataclass(frozen=True)
class TestSpec:
    model: str
    column: str
    test: str  # unique | not_null | accepted_values | relationships
    values: tuple = ()
    to_model: str = ""
    to_field: str = ""


def failing_rows(spec: TestSpec, models) -> DataFrame:
    df = models.model(spec.model)
    if spec.test == "unique":
        return unique(df, spec.column)
    if spec.test == "not_null":
        return not_null(df, spec.column)
    if spec.test == "accepted_values":
        return accepted_values(df, spec.column, spec.values)
    if spec.test == "relationships":
        return relationships(df, spec.column, models.model(spec.to_model), spec.to_field)
    raise ValueError(f"unknown test {spec.test}")


def _null_failures(df: DataFrame, tests: Sequence[tuple[int, TestSpec]]) -> DataFrame:
    """(t, failures) of not_null tests: one conditional count per column, no shuffle of rows."""
    counts = df.agg(*[F.count_if(F.col(s.column).isNull()).alias(f"t{i}") for i, s in tests])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(i).alias("t"), F.col(f"t{i}").alias("failures")) for i, _ in tests])))


def _unique_failures(df: DataFrame, i: int, column: str) -> DataFrame:
    """(t, failures) of a unique test: a count per value in the column's own type."""
    return unique(df, column).agg(F.lit(i).alias("t"), F.count(F.lit(1)).alias("failures"))


def _value_failures(df: DataFrame, tests: Sequence[tuple[int, TestSpec]]) -> DataFrame:
    """(t, failures) of accepted_values tests: the distinct combinations of their few-valued columns, then
    the distinct values outside each list."""
    combined = df.select(*dict.fromkeys(s.column for _, s in tests)).distinct()
    wrong = F.array_compact(F.array(*[
        F.when(~F.col(s.column).isin(list(s.values)), F.struct(F.lit(i).alias("t"), F.col(s.column).cast("string").alias("v")))
        for i, s in tests]))
    return combined.select(F.inline(wrong)).distinct().groupBy("t").agg(F.count(F.lit(1)).alias("failures"))


def _column_test_failures(df: DataFrame, tests: Sequence[tuple[int, TestSpec]]) -> list[DataFrame]:
    """(t, failures) relations for the unique / not_null / accepted_values tests of one model."""
    by_kind = {kind: [(i, s) for i, s in tests if s.test == kind] for kind in ("unique", "not_null", "accepted_values")}
    out = [_unique_failures(df, i, s.column) for i, s in by_kind["unique"]]
    if by_kind["not_null"]:
        out.append(_null_failures(df, by_kind["not_null"]))
    if by_kind["accepted_values"]:
        out.append(_value_failures(df, by_kind["accepted_values"]))
    return out


def summarize(specs: Iterable[TestSpec], models) -> DataFrame:
    """One result row per test ``(model, column_name, test, failures, passed)``.

    Each model needs one aggregate for its not_null tests, one over few-valued columns for its accepted_values
    tests and one count per unique column; relationships are one left-anti join each. A test whose model
    is empty reports 0 failures.
    """
    specs = list(specs)
    per_model: dict[str, list[tuple[int, TestSpec]]] = {}
    parts: list[DataFrame] = []
    for i, s in enumerate(specs):
        if s.test == "relationships":
            rel = failing_rows(s, models).agg(F.count(F.lit(1)).cast("bigint").alias("failures"))
            parts.append(rel.select(F.lit(i).alias("t"), "failures"))
        elif s.test in ("unique", "not_null", "accepted_values"):
            per_model.setdefault(s.model, []).append((i, s))
        else:
            raise ValueError(f"unknown test {s.test}")
    for name, tests in per_model.items():
        parts += _column_test_failures(models.model(name), tests)
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    spark = found.sparkSession
    catalog = spark.createDataFrame([(i, s.model, s.column, s.test) for i, s in enumerate(specs)],
                                    "t int, model string, column_name string, test string")
    out = catalog.join(found, "t", "left").withColumn("failures", F.coalesce("failures", F.lit(0).cast("bigint")))
    # rows are not globally sorted (a range shuffle for ~35 rows); sort on read if needed
    return out.select("model", "column_name", "test", "failures", (F.col("failures") == 0).alias("passed"))
