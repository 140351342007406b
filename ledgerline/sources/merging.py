"""IO4, IO6, IO8, IO9 as DataFrame operators: views, marks, schema sync, upsert."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType,
                               ShortType, StringType, TimestampNTZType, TimestampType)

# Decimal digits that whole-number types need.
DIGITS = {ByteType(): 3, ShortType(): 5, IntegerType(): 10, LongType(): 19}


def as_view(df: DataFrame, name: str) -> DataFrame:
    """IO4: register a table as a (lazy) view for SQL users; nothing is materialised."""
    df.createOrReplaceTempView(name)
    return df


def newer_than(src: DataFrame, mark: DataFrame | dt.datetime | None, col: str = "_loaded_at") -> DataFrame:
    """IO8: source rows loaded strictly after a high-water mark.

    ``mark`` is the time itself (``TableStore.mark``) or the loaded table, whose
    largest ``col`` is then read first.  The filter is a plain ``col > literal``,
    which a scan of landed files uses to skip row groups (``raw.land``).  Without a
    mark everything loads.
    """
    if isinstance(mark, DataFrame):
        mark = mark.agg(F.max(col)).first()[0]
    if mark is None:
        return src
    return src.filter(F.col(col) > F.lit(mark).cast(src.schema[col].dataType))


def widest(a: DataType, b: DataType) -> DataType:
    """The type that holds the values of both: the wider number or time, else text."""
    if a == b:
        return a
    exact = [DecimalType(DIGITS[t], 0) if t in DIGITS else t for t in (a, b)]
    if a in DIGITS and b in DIGITS:
        return max(a, b, key=DIGITS.get)
    if all(isinstance(t, DecimalType) for t in exact):
        scale = max(t.scale for t in exact)
        return DecimalType(min(38, max(t.precision - t.scale for t in exact) + scale), scale)
    if all(isinstance(t, (DecimalType, FloatType, DoubleType)) for t in exact):
        return DoubleType()
    if isinstance(a, DateType) and isinstance(b, (TimestampType, TimestampNTZType)):
        return b
    if isinstance(b, DateType) and isinstance(a, (TimestampType, TimestampNTZType)):
        return a
    return StringType()


def sync_columns(target: DataFrame, updates: DataFrame) -> DataFrame:
    """IO9: target rows in the updates' columns: new ones NULL, dropped ones gone,
    changed types in the wider of both."""
    held = {f.name: f.dataType for f in target.schema.fields}
    return target.select(*[
        F.col(f.name).cast(widest(held[f.name], f.dataType)).alias(f.name) if f.name in held
        else F.lit(None).cast(f.dataType).alias(f.name) for f in updates.schema.fields])


def latest_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the largest by ``order``, ties broken by the other columns.

    A per-key aggregate, so repeated keys are reduced map-side first.
    """
    rest = [c for c in rows.columns if c not in keys and c not in order]
    if not rest and not order:
        return rows.distinct()
    top = rows.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_top"))
    return top.select(*[F.col(c) if c in keys else F.col(f"_top.{c}") for c in rows.columns])


def upsert(target: DataFrame | None, updates: DataFrame, keys: list[str], reduced: bool = False) -> DataFrame:
    """IO6: merge by unique key -- matched rows replaced, others inserted.

    Rows of the updates that share a key are reduced to the latest by
    ``_loaded_at`` (where there is one), unless they are ``reduced`` already.
    ``left_anti`` + ``unionByName``: the anti join shuffles both sides on the key once.
    """
    if not reduced:
        updates = latest_per_key(updates, keys, [c for c in ("_loaded_at",) if c in updates.columns])
    if target is None:
        return updates
    target = sync_columns(target, updates)
    updates = updates.select(*[F.col(f.name).cast(f.dataType) for f in target.schema.fields])
    return target.join(updates.select(*keys), keys, "left_anti").unionByName(updates)
