"""Scanning of customer extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from customer_canon.errors import IngestionError

# Name of the column that carries a row's place in the input.
INPUT_POSITION = "__input_position"

# Name of the column that holds a line whose number of cells is not the header's; null for all others.
MALFORMED_LINE = "__malformed_line"


def _may_be_renamed(columns: list[str]) -> bool:
    """Whether Spark may have renamed header cells: blank ones to ``_c`` and their place,
    repeated ones by appending their place."""
    stems = [name.removesuffix(str(place)).lower() for place, name in enumerate(columns) if name.endswith(str(place))]
    return "_c" in stems or len(set(stems)) < len(stems)


def _check_headers(reader: DataFrameReader, path: str | list[str], columns: list[str]) -> bool:
    """Whether the header really holds the given names, in every file.

    Reads the first record of each file as data. IngestionError if files differ; False if they agree on
    blank or repeated cells, for which Spark made the names up.
    """
    cells = [f"cell{place}" for place in range(len(columns) + 1)]  # one more, for headers that are longer
    schema = StructType([])
    for cell in cells:
        schema = schema.add(cell, StringType())
    records = with_input_position(reader.option("header", False).schema(schema).csv(path))
    first = F.min_by(F.array(*cells), F.col(INPUT_POSITION))
    headers = records.groupBy(f"{INPUT_POSITION}.file").agg(first.alias("header")).select("header").distinct()
    found = headers.limit(2).collect()
    if len(found) > 1:
        raise IngestionError("CSV headers differ between files")
    return not found or found[0].header[:-1] == columns


def scan_csv(
    spark: SparkSession, path: str | list[str], multi_line: bool = False, keep_malformed: bool = False
) -> DataFrame:
    """All columns of one or more CSV files (any URI Spark can read), as strings.

    Nothing is inferred, so only the header is read up front. Quotes inside
    quoted cells are doubled. Every file's own header is checked against the
    first one's: a file with other columns fails the job instead of having its
    cells read under wrong names. Where names look like those that Spark makes up
    for blank or repeated cells, the first record of every file is compared at
    once; that takes a pass over the input, and a difference is an IngestionError.
    Line breaks inside quotes need ``multi_line``, which makes each file one
    unsplittable task; leave it off for large files.

    ``keep_malformed`` adds a column with the untouched line of records that have
    more or fewer cells than the header. Spark then parses all cells of a line,
    also those of columns that are not used.
    """

    def reader() -> DataFrameReader:
        return spark.read.option("escape", '"').option("multiLine", multi_line)

    scan = reader().option("header", True).option("enforceSchema", False).csv(path)
    enforced = False
    if _may_be_renamed(scan.columns):
        enforced = not _check_headers(reader(), path, scan.columns)
    if not scan.columns or not (enforced or keep_malformed):
        return scan
    schema = scan.schema
    options = reader().option("header", True).option("enforceSchema", enforced)
    if keep_malformed:
        schema = schema.add(MALFORMED_LINE, StringType())
        options = options.option("columnNameOfCorruptRecord", MALFORMED_LINE)
    return options.schema(schema).csv(path)


def with_input_position(scan: DataFrame) -> DataFrame:
    """Adds each row's place in the input: file, start of the split, row within the split.

    Must sit directly on a file scan. One split is read by one task from front
    to back, so the triple sorts like the file itself, whichever task or attempt
    read it and however splits were packed into tasks.
    """
    file = scan.metadataColumn("_metadata")
    position = F.struct(
        file["file_path"].alias("file"),
        file["file_block_start"].alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return scan.withColumn(INPUT_POSITION, position)
