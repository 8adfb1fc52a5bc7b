"""CSV in and out: header scan with all columns as text, quarantine of malformed rows, export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.functions.values import typed
from linkwright.sources.schemas import RAW, RENAMES, TYPES, text_schema

CORRUPT = "_corrupt_record"
ROW_NO = "row_no"


def read_raw(spark: SparkSession, path: str | list[str], table: str, multi_line: bool = True) -> DataFrame:
    """One raw table, every column text, with the unparsed text of malformed rows.

    Quoted line breaks need ``multi_line``, which reads a file in one task: keep files to a few
    hundred MB, or pass ``multi_line=False`` for files without line breaks in fields, which split.
    """
    return (
        spark.read.schema(text_schema(RAW[table], (CORRUPT,)))
        .option("header", True).option("quote", '"').option("escape", '"')
        .option("multiLine", multi_line).option("mode", "PERMISSIVE")
        .option("columnPruning", False)  # a row is judged by all its fields, whichever are asked for
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


def with_file_order(rows: DataFrame) -> DataFrame:
    """Add ``row_no``, a text that sorts in file order: file, block in the file, row in the block."""
    def pad(value):
        return F.lpad(value.cast("string"), 20, "0")
    return rows.withColumn(ROW_NO, F.concat_ws(
        "#", F.col("_metadata.file_path"), pad(F.col("_metadata.file_block_start")),
        pad(F.monotonically_increasing_id()),
    ))


def quarantine(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split into well-formed rows and malformed ones (short, long or broken).

    Spark refuses a plan that needs nothing but the corrupt text, as a bare count would; the always
    true test on the first column keeps one more column in it.
    """
    read = rows.filter(F.length(F.concat_ws("", F.col(rows.columns[0]))) >= 0)
    return read.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), read.filter(F.col(CORRUPT).isNotNull())


def read_table(spark: SparkSession, path: str | list[str], table: str, multi_line: bool = True) -> DataFrame:
    """The well-formed rows of a raw table in a known file order."""
    return quarantine(with_file_order(read_raw(spark, path, table, multi_line)))[0]


def typed_table(rows: DataFrame) -> DataFrame:
    """Clean names and target types; blank text in a typed column gives null."""
    renamed = rows.withColumnsRenamed({old: new for old, new in RENAMES.items() if old in rows.columns})
    return renamed.withColumns({c: typed(F.col(c), TYPES[c]) for c in renamed.columns if c in TYPES})


def write_csv(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Header CSV, quoting only the fields that need it."""
    (rows.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
     .option("emptyValue", "").csv(path))
