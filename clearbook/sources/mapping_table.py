"""The persisted dirty-to-clean mapping, one partition per domain, appended to and never rewritten."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearbook import schemas
from clearbook.operators.mapping import one_pair_each, only_new


def read_mapping(spark: SparkSession, path: str, domain: str | None = None) -> DataFrame:
    """Stored pairs, of one domain if given; an empty frame where nothing was stored yet.

    There is one pair for each domain and dirty value: the one stored first, even
    where two jobs stored different ones side by side.
    """
    try:
        mapping = spark.read.schema(schemas.MAPPING).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        mapping = spark.createDataFrame([], schemas.MAPPING)
    mapping = mapping if domain is None else mapping.where(F.col("domain") == domain)
    first = F.min_by("clean", F.struct("stored_at", "clean"))
    return mapping.groupBy("domain", "dirty").agg(first.alias("clean"))


def append_mapping(new: DataFrame, path: str, domain: str) -> None:
    """Store the pairs whose dirty value has no stored mapping yet, one for each; stored pairs always win."""
    stored = read_mapping(new.sparkSession, path, domain)
    write_pairs(one_pair_each(only_new(new, stored)), path, domain)


def write_pairs(pairs: DataFrame, path: str, domain: str, as_tasks_end: bool = False) -> None:
    """Add (dirty, clean) pairs as they are.

    With ``as_tasks_end`` each task's pairs are there when it ends, even if the
    job fails later; else they all appear when the job ends.
    """
    dated = pairs.select(F.lit(domain).alias("domain"), "dirty", "clean", F.current_timestamp().alias("stored_at"))
    committer = "mapreduce.fileoutputcommitter.algorithm.version"
    dated.write.mode("append").option(committer, "2" if as_tasks_end else "1").partitionBy("domain").parquet(path)
