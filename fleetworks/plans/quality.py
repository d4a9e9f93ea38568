"""Data tests. Every check yields the rows that break it; a report counts them.

All rules of all tables are counted together: each table is scanned once and emits one tagged row per broken row rule, per
key and per reference, and a single group-by on (rule, key hash) then counts repeated keys and references without a parent.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from fleetworks import constants as C
from fleetworks.schemas import CONSTRAINTS, Constraints
from fleetworks.sources.literals import literal_frame


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with how often. Rows with a NULL in the key do not count."""
    present = df.dropna(subset=list(keys))
    return present.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def _unlisted(column: str, values: Sequence | Column) -> Column:
    listed = F.array_contains(values, F.col(column)) if isinstance(values, Column) else F.col(column).isin(list(values))
    return F.col(column).isNotNull() & ~listed


def unlisted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.filter(_unlisted(column, values))


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose non-NULL reference has no parent."""
    known = parent.select(F.col(parent_column).alias(column)).distinct()
    return df.filter(F.col(column).isNotNull()).join(known, column, "left_anti")


#: Kinds of tagged rows: a broken row rule, an occurrence of a key, a reference.
BROKEN, KEY, REFERENCE = 0, 1, 2
_WHOLE_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _entry(when: Column, rule: int, kind: int, key: Sequence[Column] = (), n: int = 1) -> Column:
    """A tagged row where the condition holds, NULL elsewhere, with the two halves of its key."""
    low, high = key or [F.lit(0).cast("bigint")] * 2
    return F.when(when, F.struct(
        F.lit(rule).alias("rule"), F.lit(kind).alias("kind"), low.alias("h1"), high.alias("h2"),
        F.lit(n).cast("bigint").alias("n"), F.lit(n == 0).alias("parent")))


def _numbers(df: DataFrame, columns: Sequence[str]) -> list[Column] | None:
    """The columns as longs, if they are at most two whole numbers or days."""
    kinds = [df.schema[c].dataType for c in columns]
    if len(kinds) > 2 or not all(isinstance(kind, (*_WHOLE_NUMBERS, T.DateType)) for kind in kinds):
        return None
    return [(F.unix_date(c) if isinstance(kind, T.DateType) else F.col(c)).cast("bigint") for c, kind in zip(columns, kinds)]


def _keys(*sides: tuple[DataFrame, Sequence[str]]) -> list[list[Column]]:
    """Each side's columns as two longs, equal where the values are.

    One or two whole numbers or days are taken as they are, any other key as 128 bits of hash of its values as text, so
    types may differ.
    """
    kinds = [["day" if isinstance(df.schema[c].dataType, T.DateType) else "other" for c in columns] for df, columns in sides]
    numbers = [_numbers(df, columns) for df, columns in sides]
    if all(kind == kinds[0] for kind in kinds) and None not in numbers:
        return [[*side, F.lit(0).cast("bigint")][:2] for side in numbers]
    return [[F.xxhash64(F.lit(seed), *[F.col(c).cast("string") for c in columns]) for seed in (1, 2)] for _, columns in sides]


def _whole(columns: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])


def check_constraints(tables: Mapping[str, DataFrame], declared: Mapping[str, Constraints] = CONSTRAINTS) -> DataFrame:
    """Violations (check_name, violations) of the declared keys, references, domains and row rules of every given table.

    A key counts once however often it is repeated, a reference once per row. Rows with a NULL in a key or reference are
    not held against it. A reference to a table not given is reported as not checked, with no count.
    """
    names: list[str] = []
    entries: dict[str, list[Column]] = {name: [] for name in tables}
    unchecked: list[str] = []

    def rule(name: str) -> int:
        names.append(name)
        return len(names) - 1

    for table in tables:
        rules = declared[table]
        broken = {f"{c} not null": F.col(c).isNull() for c in (*rules.key, *rules.not_null)}
        broken |= {f"{c} in domain": _unlisted(c, values) for c, values in rules.allowed.items()}
        broken |= {name: F.expr(violated) for name, violated in rules.rules.items()}
        for name, violated in broken.items():
            entries[table].append(_entry(violated, rule(f"{table}: {name}"), BROKEN))
        for key in (rules.key, *rules.unique):
            if key:
                halves, = _keys((tables[table], key))
                entries[table].append(_entry(_whole(key), rule(f"{table}: {'+'.join(key)} unique"), KEY, halves))
        for column, (parent, parent_column) in rules.references.items():
            if parent not in tables:
                unchecked.append(f"{table}: {column} in {parent} (not checked)")
                continue
            number = rule(f"{table}: {column} in {parent}")
            child, known = _keys((tables[table], [column]), (tables[parent], [parent_column]))
            entries[table].append(_entry(_whole([column]), number, REFERENCE, child))
            entries[parent].append(_entry(_whole([parent_column]), number, REFERENCE, known, 0))
    # rules that a row keeps give NULL, dropped here and not by a lambda over the array: all of it is generated code
    tagged = [df.select(F.inline(F.array(*entries[name]))).filter(F.col("rule").isNotNull())
              for name, df in tables.items() if entries[name]]
    spark = next(iter(tables.values())).sparkSession
    counted = reduce(DataFrame.unionByName, tagged).groupBy("rule", "kind", "h1", "h2").agg(
        F.sum("n").alias("n"), F.max("parent").alias("parent"))
    found = (
        F.when(F.col("kind") == KEY, (F.col("n") > 1).cast("bigint"))
        .when((F.col("kind") == REFERENCE) & F.col("parent"), F.lit(0)).otherwise(F.col("n")))
    violations = counted.groupBy("rule").agg(F.sum(found).alias("violations"))
    checks = literal_frame(spark, "rule int; check_name string", [*enumerate(names), *((-1, name) for name in unchecked)])
    return checks.join(violations, "rule", "left").select(
        "check_name", F.when(F.col("rule") >= 0, F.coalesce("violations", F.lit(0))).alias("violations"))


# The tests on finished results. Domains can be replaced where a site's branches differ.
RESULT_CHECKS: dict[str, Constraints] = {
    # one row per customer and month, so the customer is no key
    "finance_monthly": Constraints((), ("customer_id", "industry_id", "total_revenue")),
    "warehouse_inventory": Constraints(
        ("part_id", "branch", "snapshot_date"), ("unit_cost_ghs",), (), {}, {"branch": C.BRANCHES},
        {"inventory value not negative": "inventory_value_ghs < 0"}),
    "predictive_signals": Constraints(
        ("signal_id",), ("failure_probability",), (), {}, {"signal_status": C.SIGNAL_STATUSES},
        {"failure probability in range": "failure_probability < 0 OR failure_probability > 1"}),
    "fleet_operations": Constraints(("equipment_id",), (), (), {}, {"ownership_type": C.OWNERSHIP_TYPES}),
    "catalog_gaps": Constraints(("gap_id",), ("component_id", "model_id")),
    "branch_performance": Constraints((), (), (), {}, {"branch": C.BRANCHES}),
    "customer_concentration": Constraints(("customer_id",), ("revenue_rank",)),
}


def check_results(results: Mapping[str, DataFrame], branches: Sequence[str] | Column = C.BRANCHES) -> DataFrame:
    """The data tests on finished results; ``branches`` may be an array column."""
    declared = {name: replace(RESULT_CHECKS[name], allowed={
        c: branches if c == "branch" else values for c, values in RESULT_CHECKS[name].allowed.items()}) for name in results}
    return check_constraints(results, declared)
