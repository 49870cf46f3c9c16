"""The data contract, evaluated lazily: every failing value becomes one row."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wearlens.contract import Rule, contract_rules, contract_types, require_columns
from wearlens.operators.cleaning import absent


def wrong_types(df: DataFrame) -> list[tuple[str, str]]:
    """Columns that are missing or not of the contract type; nothing is coerced and no job runs."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    return [
        (c, actual[c].simpleString() if c in actual else "absent")
        for c, want in contract_types().items()
        if not isinstance(actual.get(c), want)
    ]


def duplicate_ids(df: DataFrame, id_col: str = "unit_id") -> DataFrame:
    """One row per row whose id occurs more than once."""
    repeated = df.groupBy(id_col).count().filter("count > 1").select(id_col)
    return df.select(id_col).join(repeated, id_col, "left_semi")


def contract_failures(
    df: DataFrame, rules: list[Rule] | None = None, id_col: str = "unit_id", unique: bool = True
) -> DataFrame:
    """``<id>, column, check, value``: one row per failure. Columns outside the contract are ignored."""
    rules = contract_rules() if rules is None else rules
    columns = list(dict.fromkeys(r.column for r in rules))
    require_columns(df, columns)

    def case(cond, column, check):
        return F.when(
            cond,
            F.struct(
                F.lit(column).alias("column"), F.lit(check).alias("check"), F.col(column).cast("string").alias("value")
            ),
        )

    cases = [case(absent(df, c), c, "not_null") for c in columns]
    cases += [case(~absent(df, r.column) & ~r.holds, r.column, r.check) for r in rules]
    found = df.select(id_col, F.inline(F.filter(F.array(*cases), lambda f: f.isNotNull())))
    if not unique:
        return found
    twice = duplicate_ids(df, id_col).select(
        id_col,
        F.lit(id_col).alias("column"),
        F.lit("unique").alias("check"),
        F.col(id_col).cast("string").alias("value"),
    )
    return found.unionByName(twice)


def failures_by_check(failures: DataFrame) -> DataFrame:
    return failures.groupBy("column", "check").agg(F.count(F.lit(1)).alias("failures"))


def failure_sample(failures: DataFrame, n: int = 10, id_col: str = "unit_id") -> DataFrame:
    """The first ``n`` failures by id, column and check."""
    return failures.orderBy(id_col, "column", "check").limit(n)


def validate(df: DataFrame) -> tuple[bool, DataFrame]:
    """Whether the contract holds, and the failures by check. Type mismatches fail at once."""
    types = wrong_types(df)
    if types:
        spark = df.sparkSession
        rows = [(c, f"type:{t}", 1) for c, t in types]
        return False, spark.createDataFrame(rows, "column string, check string, failures long")
    by_check = failures_by_check(contract_failures(df))
    return by_check.isEmpty(), by_check
