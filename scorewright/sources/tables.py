"""Table scans and inline constant relations (OP-01, OP-04)."""

from __future__ import annotations

import datetime as _dt
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def table_path(root: str, name: str) -> str:
    return os.path.join(root, f"{name}.parquet")


def scan(spark: SparkSession, source: str, cols: Sequence[str] | None = None, root: str | None = None) -> DataFrame:
    """Read a catalog table (``name``) or a parquet table (``root``/name.parquet).

    Only the listed columns are selected; Catalyst prunes the parquet
    ``ReadSchema`` to them and pushes later filters into the scan.
    """
    if root is not None:
        df = spark.read.parquet(table_path(root, source))
    elif "/" in source or source.endswith(".parquet"):
        df = spark.read.parquet(source)
    else:
        df = spark.table(source)
    return df.selectExpr(*cols) if cols else df


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    if isinstance(v, _dt.date):
        return f"DATE '{v.isoformat()}'"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def constants(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small typed relation from literal rows (mapping tables, catalogues).

    Built as an inline ``VALUES`` table, so the plan holds a LocalRelation
    whose exact size the planner knows: it is broadcast wherever it is joined
    (an RDD-backed frame would have unknown size and be shuffled).
    """
    fields = [f.strip().split(None, 1) for f in schema.split(",")]
    names = [n for n, _ in fields]
    rows = list(rows)
    select = ", ".join(f"CAST({n} AS {t}) AS {n}" for n, t in fields)
    if not rows:
        nulls = ", ".join("NULL" for _ in names)
        return spark.sql(f"SELECT {select} FROM VALUES ({nulls}) AS t({', '.join(names)}) WHERE false")
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    return spark.sql(f"SELECT {select} FROM VALUES {values} AS t({', '.join(names)})")
