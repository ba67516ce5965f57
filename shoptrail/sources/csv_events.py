"""Source CSV files: plain or gzip, one file, a folder, or the first candidate that exists."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from shoptrail.schemas import SOURCE_CSV

#: Where the source lies by convention, and its files, the first month also in the folder above.
SOURCE_FOLDER = "data/raw/source"
SOURCE_MONTHS = ("2019-Oct", "2019-Nov", "2019-Dec", "2020-Jan")


def require_columns(present: list[str], expected: list[str]) -> None:
    missing = [name for name in expected if name not in present]
    if missing:
        raise ValueError(f"missing expected columns: {', '.join(missing)}")


def _reader(spark: SparkSession, folder: bool):
    # Fields may hold quoted line breaks only if multiLine is set, which would make files
    # unsplittable; event files have none.
    reader = spark.read.options(header=True, encoding="UTF-8", escape='"', enforceSchema=False)
    return reader.option("pathGlobFilter", "*.{csv,gz}") if folder else reader


def read_csv_events(
    spark: SparkSession, path: str | list[str], schema: StructType = SOURCE_CSV, folder: bool = False
) -> DataFrame:
    """All-text scan by column name, whatever order the header has.

    All expected columns must be there. Files whose header differs from the first one's are refused
    rather than read askew. Gzip files are read whole by one task each (they cannot be split).
    """
    header = _reader(spark, folder).option("inferSchema", False).csv(path)
    require_columns(header.columns, schema.names)
    return header.select(*schema.names)


def read_first_available(spark: SparkSession, candidates: list[str]) -> DataFrame:
    """The first candidate that exists, in order."""
    for path in candidates:
        try:
            return read_csv_events(spark, path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"none of the source files exists: {', '.join(candidates)}")


def read_default_source(spark: SparkSession, folder: str = SOURCE_FOLDER) -> DataFrame:
    """The source where it is by convention: the first of the known files (plain before gzip), else all CSV files of the
    folder."""
    folder = folder.rstrip("/")
    first, *later = SOURCE_MONTHS
    places = [f"{folder}/{first}", f"{folder.rpartition('/')[0]}/{first}", *(f"{folder}/{month}" for month in later)]
    try:
        return read_first_available(spark, [f"{place}.{kind}" for place in places for kind in ("csv", "csv.gz")])
    except FileNotFoundError:
        try:
            return read_csv_events(spark, folder, folder=True)
        except (AnalysisException, ValueError) as error:
            raise FileNotFoundError(f"no source CSV in {folder}: expected one of {', '.join(SOURCE_MONTHS)} or other CSV files") from error


def write_csv_events(rows: DataFrame, path: str, gzip: bool = False) -> None:
    """Write rows as CSV with a header; spaces and empty fields stay as they are."""
    options = {
        "header": True,
        "escape": '"',
        "emptyValue": "",
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
        "compression": "gzip" if gzip else "none",
    }
    rows.write.mode("overwrite").options(**options).csv(path)
