"""The schema contract of the layer tables, checked before a layer writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata import schema
from strata.sources.versions import partition_columns

DIFFERENCE = "table_name string, column_name string, problem string, expected string, found string"


class ContractError(RuntimeError):
    """A layer table differs from its model in a way that a load must not go on with."""


def contract_rows(spark: SparkSession, database: str, *names: str) -> list[tuple]:
    """(table, column, problem, expected, found) per difference. ``missing`` and ``type`` are breaches, and so is
    ``partition``, other partition columns or another order; ``extra`` columns, which a source has added, are allowed."""
    rows = []
    for name in names or schema.TABLES:
        model, table = schema.TABLES[name], spark.table(f"{database}.{name}")
        have = {f.name: f.dataType.simpleString() for f in table.schema.fields}
        want = {f.name: f.dataType.simpleString() for f in model.schema.fields}
        for column, kind in want.items():
            if column not in have:
                rows.append((name, column, "missing", kind, None))
            elif have[column] != kind:
                rows.append((name, column, "type", kind, have[column]))
        rows += [(name, column, "extra", None, kind) for column, kind in have.items() if column not in want]
        parts = partition_columns(spark, f"{database}.{name}")
        if parts != list(model.partitions):
            rows.append((name, None, "partition", ",".join(model.partitions), ",".join(parts)))
    return rows


def contract_differences(spark: SparkSession, database: str, *names: str) -> DataFrame:
    """The differences of the layer tables (all, if none are named) from their models, one row each."""
    return spark.createDataFrame(contract_rows(spark, database, *names), DIFFERENCE)


def require_contract(spark: SparkSession, database: str, *names: str) -> None:
    """Stop a layer before its write if one of its tables breaks the contract."""
    broken = [r for r in contract_rows(spark, database, *names) if r[2] != "extra"]
    if broken:
        raise ContractError("; ".join(f"{t}.{c or ''} {p}: {want} expected, {found} found" for t, c, p, want, found in broken))
