"""Renames, blank replacement and casts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnkit.functions import is_blank, named
from churnkit.operators.profile import counted_where
from churnkit.spec import TableSpec


def rename(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Rename, matching the old names without regard to case; an absent one is an error."""
    present = {c.lower(): c for c in df.columns}
    absent = [old for old in renames if old.lower() not in present]
    if absent:
        raise ValueError(f"columns to rename are missing: {', '.join(absent)}")
    return df.withColumnsRenamed({present[old.lower()]: new for old, new in renames.items()})


def drop(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def _filled(df: DataFrame, column: str, text: str, fill_missing: bool):
    value = named(column)
    if not isinstance(df.schema[column].dataType, T.StringType):
        return F.coalesce(value, F.lit(float(text))) if fill_missing else value
    if fill_missing:
        return F.when(value.isNull() | is_blank(column), F.lit(text)).otherwise(value)
    return F.when(value == F.lit(" "), F.lit(text)).otherwise(value)


def fill_blanks(df: DataFrame, spec: TableSpec, strict: bool = True) -> DataFrame:
    """Replace cells that are exactly one blank, then cast to double.

    With ``spec.fill_missing`` empty and null cells are filled as well. Other text that is no number fails the
    job, whatever the session's ANSI mode; with ``strict=False`` it becomes null (see ``rejected_cells``).
    """
    cells = {c: _filled(df, c, text, spec.fill_missing) for c, text in spec.blank_fill.items()}
    return df.withColumns({c: _number(c, v) if strict else v.try_cast("double") for c, v in cells.items()})


def _number(column: str, value: Column) -> Column:
    number = value.try_cast("double")
    bad = F.raise_error(F.concat(F.lit(f"not a number in {column}: "), value.cast("string")))
    return F.when(value.isNotNull() & number.isNull(), bad.cast("double")).otherwise(number)


def rejected_cells(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Per blank-filled column, the cells that are neither blank nor a number."""
    cells = {c: _filled(df, c, text, spec.fill_missing) for c, text in spec.blank_fill.items()}
    return counted_where(df, {c: v.isNotNull() & v.try_cast("double").isNull() for c, v in cells.items()})


def clean(df: DataFrame, spec: TableSpec, strict: bool = True) -> DataFrame:
    """Renamed, filled and cast; every column that the spec names must be there."""
    renamed = rename(df, spec.renames)
    wanted = {*spec.keys, spec.label, *spec.blank_fill, *(spec.numeric or ()), *(spec.categorical or ())}
    absent = sorted(wanted - set(renamed.columns))
    if absent:
        raise ValueError(f"columns are missing: {', '.join(absent)}")
    return fill_blanks(renamed, spec, strict)
