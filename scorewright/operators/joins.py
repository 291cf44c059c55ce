"""Joins (SURVEY C).

No join carries a broadcast hint.  Spark broadcasts a side when its size in
bytes (file statistics, or what AQE measured at run time) is within
``spark.sql.autoBroadcastJoinThreshold``, and splits skewed partitions of the
joins it shuffles.  A join on a key with few values goes through
``spread_join``, so that above the threshold it never puts a whole key value
into one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 64      # tasks over which each value of a low-cardinality join key is spread


def spread_join(df: DataFrame, other: DataFrame, on: str, spread: str, how: str = "left", salts: int = SALTS) -> DataFrame:
    """Equi-join on a key with few values: ``df`` rows of a key are dealt over ``salts`` parts by ``spread``.

    ``on`` is the SQL join condition, ``spread`` an SQL expression over ``df``.
    ``other`` is repeated once per part; the result is that of the plain join.
    """
    left = df.withColumn("_salt", F.expr(f"pmod(xxhash64({spread}), {int(salts)})"))
    right = other.selectExpr("*", f"explode(sequence(0L, {int(salts) - 1}L)) AS _part")
    return left.join(right, F.expr(f"{on} AND _salt = _part"), how).drop("_salt", "_part")


def left_join(base: DataFrame, other: DataFrame, on, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Left outer equi-join; fan-out from duplicate right keys is kept.

    ``defaults`` fills NULLs of the listed right-side columns (missing -> 0).
    """
    out = base.join(other, on=on, how="left")
    for name, value in (defaults or {}).items():
        out = out.withColumn(name, F.coalesce(F.col(name), F.lit(value)))
    return out


def widen(spine: DataFrame, facts: Sequence[DataFrame], key: str) -> DataFrame:
    """Chain of left joins of pre-aggregated facts onto one spine, on one key.

    Each fact arrives aggregated to (at most a few rows per) key, so every join
    is key-to-key; with the same key the spine is shuffled once and the later
    sort-merge joins reuse its partitioning.
    """
    out = spine
    for fact in facts:
        out = out.join(fact, on=key, how="left")
    return out


def inner_join_chain(first: DataFrame, mapping: DataFrame, last: DataFrame, on_first, on_last) -> DataFrame:
    """a JOIN map ON ... JOIN b ON ... (two inner equi-joins)."""
    return first.join(mapping, on=on_first, how="inner").join(last, on=on_last, how="inner")


def semi_join(df: DataFrame, evidence: DataFrame, on) -> DataFrame:
    """Rows of ``df`` with at least one matching evidence row (EXISTS); never duplicates."""
    return df.join(evidence, on=on, how="left_semi")


def lookup(df: DataFrame, dim: DataFrame, key: str, value: str, alias: str | None = None) -> DataFrame:
    """Correlated scalar subquery: ``(SELECT value FROM dim WHERE dim.key = df.key)`` as a column of ``df``.

    NULL where no row matches (a NULL key never does).  A key of ``df`` with
    two matching rows raises at run time, as a scalar subquery must; a repeated
    key that nothing asks for doesn't.  The subquery counts its rows, so Spark
    turns it into a left join with ``dim`` aggregated by key, which it can
    broadcast or shuffle; its own check for a second row is made by a nested
    loop beyond the broadcast threshold.
    """
    name = alias or value
    picked = dim.select(F.col(key).alias("_lookup_key"), F.col(value).alias("_lookup_value"))
    # a name of its own for the outer key, so that it can't be taken for a column of ``dim``
    matches = picked.where(F.col("_lookup_key") == F.col("_outer_key").outer()).select(
        F.expr("named_struct('n', count(1), 'v', any_value(_lookup_value))")).scalar()
    found = df.withColumn("_outer_key", F.col(key)).select(*df.columns, matches.alias("_found"))
    kind = dim.schema[value].dataType.simpleString()
    return found.selectExpr(*[f"`{c}`" for c in df.columns], f"""CASE WHEN _found.n > 1
        THEN CAST(raise_error('more than one row for {key} ' || CAST(`{key}` AS STRING)) AS {kind}) ELSE _found.v END AS `{name}`""")


def cross_with_constants(df: DataFrame, rows: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    """Every row of ``df`` paired with each of a few constant rows, without a join.

    The source writes this as a cross join with a literal relation; here the
    constants become one array of structs that ``inline`` expands per input
    row (a single Generate, no join, no shuffle, no pair enumeration).
    """
    from scorewright.functions.sql import lit

    structs = ", ".join(
        "named_struct(" + ", ".join(f"'{n}', {lit(v)}" for n, v in zip(names, r)) + ")" for r in rows
    )
    return df.selectExpr("*", f"inline(array({structs}))")
