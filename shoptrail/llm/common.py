"""What several operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shoptrail.session import cut_lineage

#: White space between words, as a character class body for Java and Python patterns.
BLANKS = "\\x20\\x09-\\x0D"
WORD = f"[^{BLANKS}]+"
#: The same characters, for functions that take a list of them.
BLANK_CHARS = " \t\n\x0b\x0c\r"

__all__ = [
    "BLANKS", "BLANK_CHARS", "WORD", "add_columns", "cut_lineage", "free_name", "id_remainder", "row_key", "slices",
    "table", "texts_of", "word_count", "words", "StorageLevel",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{BLANKS}]+"), "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def id_remainder(column: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % parts


def row_key(*columns: str) -> Column:
    """16 bytes naming the content of a row; null differs from empty, and fields can't run together."""
    parts = [
        F.coalesce(F.concat(F.octet_length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-"))
        for c in columns
    ]
    return F.unhex(F.md5(F.concat(*parts)))


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that no column of ``df`` has, whatever their letters' case."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows, so that a task holds few texts as Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def texts_of(column: pa.Array) -> list[str | None]:
    """Python texts of an Arrow column; bytes that are no UTF-8 become U+FFFD."""
    try:
        return column.to_pylist()
    except UnicodeDecodeError:
        return [None if x is None else x.decode("utf-8", "replace") for x in column.cast(pa.binary()).to_pylist()]


def add_columns(
    df: DataFrame, reads: list[str], adds: dict[str, tuple[str, pa.DataType]], make: Callable[[], Callable], rows: int = 256,
    drops: tuple[str, ...] = (),
) -> DataFrame:
    """Rows of ``df`` without the columns ``drops`` and with those of ``adds`` (name to Spark type and Arrow type), in place
    of any of those names.

    ``make()`` is called once per task and gives a function from the slices of the columns read to one list or array
    per column added. All other columns pass through as Arrow arrays: no value of theirs becomes a Python object or
    a floating-point number, so ids beyond 2^53 stay what they are beside nulls.
    """
    kept = [name for name in df.columns if name not in adds and name not in drops]
    fields = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema if f.name in kept]
    fields += [f"`{name}` {kind}" for name, (kind, _) in adds.items()]
    kinds = [kind for _, kind in adds.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for part in slices(batches, rows):
            found = work(*(part.column(name) for name in reads))
            made = [x if isinstance(x, pa.Array) else pa.array(x, kind) for x, kind in zip(found, kinds)]
            yield pa.RecordBatch.from_arrays([*(part.column(name) for name in kept), *made], names=[*kept, *adds])

    return df.mapInArrow(run, ", ".join(fields))
