"""File scans and sinks: raw and clean transactions, weekly series, result document, delivery log."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from clearbook import schemas
from clearbook.functions.numeric import finite
from clearbook.functions.text import missing_to_null
from clearbook.functions.vocabulary import MISSING_TOKENS
from clearbook.sources.staging import stage


def _scan(reader, path: str, kind: str, hint: str) -> DataFrame:
    try:
        return getattr(reader, kind)(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"{path} not found. {hint}") from error
        raise


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    hint: str = "",
    multi_line: bool = False,
    missing_tokens: Sequence[str] = (),
) -> DataFrame:
    """Headed CSV with doubled quotes: columns by the names in the header, cast to ``schema``.

    A missing column raises before anything is read; further columns are left
    out, and the order does not matter. All files of a folder need one header:
    a file with another one stops the job. Values that do not fit their type,
    ``missing_tokens``, NaN and the infinities become null.

    Large files are split between tasks. A quoted line break, or a record with
    too few or too many fields, then stops the job, as a record could be cut in
    two; ``multi_line=True`` reads such files, each in one task, and ``scan_csv``
    sets damaged records aside. Files with a single column are always read in
    one task each, as half a record looks like a whole one.
    """
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    # with one column alone, half a record would look like a whole one
    options = {"header": True, "escape": '"', "multiLine": multi_line}
    header = _scan(spark.read.options(**options), path, "csv", hint)
    schemas.require_columns(header, wanted.fieldNames(), path)
    options["multiLine"] = multi_line or len(header.columns) == 1
    if not options["multiLine"]:
        options |= {"mode": "FAILFAST", "columnPruning": False}
    texts = StructType([StructField(name, StringType()) for name in header.columns])
    rows = spark.read.options(**options, enforceSchema=False).schema(texts).csv(path)
    return rows.select([_typed(field, missing_tokens).alias(field.name) for field in wanted])


class DamagedRecords(ValueError):
    """A file holds more damaged records than the caller tolerates."""


@dataclass(frozen=True)
class CsvScan:
    """The records of some CSV files: ``rows`` are whole, ``rejected`` is (file, record, problem) of the damaged ones."""

    rows: DataFrame
    rejected: DataFrame
    n_rows: int
    n_rejected: int


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    hint: str = "",
    missing_tokens: Sequence[str] = (),
    tolerated: float = 0.0,
) -> CsvScan:
    """Headed CSV in which some records may be damaged: whole records and rejected ones, each apart.

    A record is a line. It is rejected if it has too few or too many fields, or
    a quote that is not closed: so both halves of a record are rejected that a
    quoted line break has cut in two, wherever the cut is. Columns are bound by
    the names in the header and cast as ``read_csv`` does; blank lines are no
    records, and neither are lines that repeat the header. A file without the
    header of the others raises ValueError, and more than the share
    ``tolerated`` of rejected records raises DamagedRecords.

    Files of any size are split between tasks, unless they are compressed. They
    are read once: the records are staged, whole and rejected ones side by side,
    as for folders of their own each task would have to sort its rows.
    """
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    header = _scan(spark.read.options(header=True, escape='"'), path, "csv", hint)
    names = schemas.require_columns(header, wanted.fieldNames(), path).columns
    line = F.col("value")
    cells = [f"c{i}" for i in range(len(names))]
    parsed = F.from_csv(
        line,
        ", ".join(f"{cell} string" for cell in [*cells, "damaged"]),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "damaged", "escape": '"'},
    )
    lines = spark.read.text(path).where(F.trim(line) != "").select("value", F.col("_metadata.file_path").alias("file"))
    is_header = F.lit(True)
    for cell, name in zip(cells, names, strict=True):
        is_header = is_header & F.coalesce(F.col(f"parsed.{cell}") == name, F.lit(False))
    open_quote = (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1
    problem = F.when(open_quote, "open quote").when(F.col("parsed.damaged").isNotNull(), "number of fields")
    judged = lines.withColumn("parsed", parsed).select("file", "value", "parsed", problem.alias("problem"))
    kind = F.when(F.col("problem").isNotNull(), "rejected").when(is_header, "header").otherwise("row")
    kept = [F.when(F.col("problem").isNull(), F.col(f"parsed.{cell}")).alias(cell) for cell in cells]
    record = F.when(F.col("problem").isNotNull(), line).alias("record")
    judged = judged.select("file", *kept, record, "problem", kind.alias("kind"))
    staged = stage(judged, "scan", compression="zstd")

    counts = {row.kind: row["count"] for row in staged.groupBy("kind").count().collect()}  # three kinds
    headed = staged.where("kind = 'header'").select("file").distinct()
    other = staged.where("kind <> 'header'").select("file").distinct().join(headed, "file", "left_anti").first()
    if other is not None:
        raise ValueError(f"{other.file} has not the header of the other files: {names}")
    n_rows, n_rejected = counts.get("row", 0), counts.get("rejected", 0)
    rejected = staged.where("kind = 'rejected'").select("file", "record", "problem")
    if n_rejected > tolerated * (n_rows + n_rejected):
        examples = [row.record for row in rejected.limit(3).collect()]
        raise DamagedRecords(f"{n_rejected} of {n_rows + n_rejected} records of {path} are damaged, such as {examples}")
    places = dict(zip(names, cells, strict=True))
    typed = [_typed(field, missing_tokens, places[field.name]).alias(field.name) for field in wanted]
    return CsvScan(staged.where("kind = 'row'").select(typed), rejected, n_rows, n_rejected)


def _typed(field: StructField, missing_tokens: Sequence[str], column: str | None = None) -> Column:
    text = F.col(f"`{column or field.name}`")
    value = missing_to_null(text, missing_tokens) if missing_tokens else text
    if isinstance(field.dataType, StringType):
        return value
    typed = value.try_cast(field.dataType)
    return finite(typed) if isinstance(field.dataType, DoubleType) else typed


def write_csv(df: DataFrame, path: str) -> None:
    """Headed CSV that keeps outer blanks, so a scan gives back what was written."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_raw_csv(
    spark: SparkSession,
    path: str,
    missing_tokens: Sequence[str] = tuple(MISSING_TOKENS),
    multi_line: bool = False,
) -> DataFrame:
    """Raw transactions as text, with the usual missing-value texts turned into null."""
    return read_csv(spark, path, schemas.RAW, "Write the raw transactions first.", multi_line, missing_tokens)


def scan_raw_records(spark: SparkSession, path: str, tolerated: float = 0.0) -> CsvScan:
    """Raw transactions as text, damaged records apart."""
    return scan_csv(
        spark, path, schemas.RAW, "Write the raw transactions first.", tuple(MISSING_TOKENS), tolerated=tolerated
    )


def read_clean_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Clean transactions from CSV; missing-value texts, NaN and the infinities are null."""
    return read_csv(spark, path, schemas.CLEAN, "Run the cleaning job first.", multi_line, tuple(MISSING_TOKENS))


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    """Clean transactions from parquet, checked for the columns the analysis needs; NaN and the infinities are null."""
    clean = _scan(spark.read, path, "parquet", "Run the cleaning job first.")
    checked = schemas.require_columns(clean, schemas.CLEAN_COLUMNS, path)
    return checked.withColumn("revenue_usd_clean", finite(F.col("revenue_usd_clean").cast("double")))


def read_weekly_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.WEEKLY, "Run the analysis job first.")


def write_results(document: DataFrame, path: str) -> None:
    """The one-row result document as JSON, nulls kept as fields."""
    document.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_breakdown(spark: SparkSession, path: str, dimension: str) -> DataFrame:
    """A breakdown table of the analysis job, all of its values."""
    return read_csv(spark, path, schemas.breakdown(dimension), "Run the analysis job first.")


def read_results(spark: SparkSession, path: str) -> DataFrame:
    reader = spark.read.schema(schemas.RESULTS).option("multiLine", True)
    return _scan(reader, path, "json", "Run the analysis job first.")


def append_delivery(entries: DataFrame, path: str) -> None:
    """Add audit records to the delivery log (one JSON object per line)."""
    entries.write.mode("append").json(path)


def read_delivery_log(spark: SparkSession, path: str) -> DataFrame:
    """The delivery log; a damaged line keeps its text in ``corrupt_record`` and spoils no other line."""
    reader = (
        spark.read.schema(schemas.DELIVERY + ", corrupt_record string")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "corrupt_record")
    )
    return _scan(reader, path, "json", "Deliver a report first.")
