"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from churnkit.spec import SplitSpec, TableSpec


def named(column: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + column.replace("`", "``") + "`")


def is_blank(column: str) -> Column:
    """True for '' and ' '. For text columns only: a number is never blank."""
    return named(column).isin("", " ")


def round_half_even(column: Column) -> Column:
    """To a whole number, halves to the even neighbour."""
    return F.bround(column.cast("double"), 0)


# One digest per row serves all three markers: 60 of its bits, 20 for each.
_BITS = 20
_SPLIT, _SAMPLE, _FOLD = 0, 1, 2


def key_bits(spec: TableSpec, split: SplitSpec) -> Column:
    """60 bits that depend on the key and the seed alone.

    The same row gets the same bits whatever the partitioning and however often a task is retried, which
    ``rand(seed)`` does not promise. Null key parts are skipped, so every row gets a number.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(split.seed)), *[named(k).cast("string") for k in spec.keys]))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def _position(bits: Column, part: int) -> Column:
    """One third of the bits as a number in [0, 1), independent of the other two thirds."""
    own = F.shiftright(bits, _BITS * part).bitwiseAND(F.lit(2**_BITS - 1))
    return own.cast("double") / F.lit(float(2**_BITS))


def split_position(bits: Column) -> Column:
    return _position(bits, _SPLIT)


def sample_position(bits: Column) -> Column:
    return _position(bits, _SAMPLE)


def fold_number(bits: Column, folds: int) -> Column:
    """Fold in 0 .. folds-1."""
    return F.floor(_position(bits, _FOLD) * F.lit(float(folds))).cast("int")


def label_value(spec: TableSpec) -> Column:
    """1.0 for the positive value, 0.0 for any other, null for null; never decided by which class is rarer."""
    text = named(spec.label).cast("string")
    return (text == F.lit(spec.positive_value)).cast("double")


def required_label(spec: TableSpec) -> Column:
    """``label_value``, but a null label fails the job instead of training on it."""
    return F.coalesce(label_value(spec), F.raise_error(F.lit(f"null label in {spec.label}")).cast("double"))
