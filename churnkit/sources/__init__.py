"""Readers, writers and the workspace for tables that cut lineage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnkit.functions import named
from churnkit.sources.workspace import Workspace, shared_folder  # noqa: F401

# Nulls are empty cells and empty texts are quoted. The reader needs a text for nulls that no cell has.
_CSV = {"header": True, "escape": '"'}
_CSV_NULL = "\x00\x00"
# What stands for a line break in a cell, and for the mark itself.
_MARK = "\\"
_BREAKS = {"\n": _MARK + "n", "\r": _MARK + "r"}


def escaped(cell: Column) -> Column:
    """The text on one line: marks doubled, line breaks spelt out."""
    for plain, spelt in {_MARK: _MARK * 2, **_BREAKS}.items():
        cell = F.replace(cell, F.lit(plain), F.lit(spelt))
    return cell


def unescaped(cell: Column) -> Column:
    """``escaped`` undone. Between doubled marks a single one begins a line break that is spelt out."""

    def with_breaks(part: Column) -> Column:
        for plain, spelt in _BREAKS.items():
            part = F.replace(part, F.lit(spelt), F.lit(plain))
        return part

    parts = F.split(cell, r"\\\\", -1)
    return F.array_join(F.transform(parts, with_breaks), _MARK)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, line_breaks: bool = False
) -> DataFrame:
    """CSV with a header row. Without a schema the types are inferred, which reads the input once more.

    An empty cell is null, a quoted empty one is an empty text. ``line_breaks`` says that ``write_csv`` has spelt out those in
    text cells. A row is one line either way, so large files are read by many tasks.
    """
    reader = spark.read.options(**_CSV, nullValue=_CSV_NULL, emptyValue="")
    read = reader.option("inferSchema", True).csv(path) if schema is None else reader.schema(schema).csv(path)
    return read.withColumns({c: unescaped(named(c)) for c in _text_columns(read)}) if line_breaks else read


def rows_table(spark: SparkSession, rows: Sequence[Mapping], schema: T.StructType | str) -> DataFrame:
    """A table from a few driver-side rows, such as one per trained model."""
    return spark.createDataFrame([dict(r) for r in rows], schema)


def _writer(df: DataFrame, files: int | None, mode: str):
    # Spreading over `files` tasks keeps the work before it parallel; coalesce would pull that in, too. Without a number
    # files get about ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` each, whatever partitions the plan ends with.
    return (df.hint("rebalance") if files is None else df.repartition(files)).write.mode(mode)


def write_json(df: DataFrame, path: str, files: int | None = None, mode: str = "overwrite") -> None:
    _writer(df, files, mode).json(path)


def write_csv(
    df: DataFrame, path: str, files: int | None = None, mode: str = "overwrite", line_breaks: bool = False
) -> None:
    """CSV with a header row that ``read_csv`` gives back cell for cell. Vector columns are refused.

    A cell with a line break fails the job unless ``line_breaks`` has them spelt out as ``\\n`` and ``\\r`` (and ``\\`` doubled) in
    text cells, since a reader that takes each line for a row would not notice.
    """
    vectors = _vector_columns(df)
    if vectors:
        raise ValueError(f"CSV cannot hold vector columns: {', '.join(vectors)}")
    on_one_line = (lambda c: escaped(named(c))) if line_breaks else _single_line
    df = df.withColumns({c: on_one_line(c) for c in _text_columns(df)})
    _writer(df, files, mode).options(**_CSV, nullValue="", emptyValue='""').csv(
        path, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


def _single_line(column: str) -> Column:
    broken = F.raise_error(F.lit(f"line break in a cell of {column}; allow it with line_breaks"))
    return F.when(named(column).rlike("[\r\n]"), broken).otherwise(named(column))


def write_parquet(
    df: DataFrame,
    path: str,
    files: int | None = None,
    mode: str = "overwrite",
    vectors_as_arrays: bool = False,
) -> None:
    """Parquet; on request with plain arrays in place of vectors, for readers other than Spark."""
    if vectors_as_arrays:
        df = df.withColumns({c: vector_to_array(named(c)) for c in _vector_columns(df)})
    _writer(df, files, mode).parquet(path)


def _text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _vector_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, VectorUDT)]


def preview(df: DataFrame, n: int = 20, order_by: Sequence[str] = ()) -> DataFrame:
    """The first n rows; with an order the same n every time."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: position, type, and how many rows have a value there."""
    counted = df.agg(*[F.count(named(f.name)).alias(f"c{i}") for i, f in enumerate(df.schema.fields)])
    rows = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col(f"c{i}").alias("n_filled"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return counted.select(F.inline(F.array(*rows)))
