"""Answers of an external resolver, stored batch by batch, so that a rerun asks for nothing twice.

Batches go out in waves. A task's file is moved to the mapping table when the
task ends, not when the job does. In the first wave each batch is a task of its
own. A task takes about a tenth of a second besides its calls, so if the slowest
call of a wave took less than TASK_SECONDS, as many batches as it could have
answered in that time share a task of the next wave. So a batch is stored as a
whole or not at all, whatever becomes of the other tasks, of the job or of the
driver, and a lost task loses one call, or those of half a second. A call that
raises costs its own batch: the others of the wave are stored, and then the
failure is raised. A rerun works on the values without a stored answer.

The batches are staged in a folder for each wave, or for several small ones, so
that a wave reads no other.

A task whose answers were moved just before its executor was lost is run again
and stores its batch twice. Reading takes the pair stored first, so that shows
nowhere.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from clearbook.operators.mapping import only_new
from clearbook.operators.resolver import BATCH_SIZE, Finish, Resolver, ask, batches_of, open_answers
from clearbook.sources.mapping_table import read_mapping, write_pairs
from clearbook.sources.staging import stage

AT_ONCE = 200  # batches of a wave

# Batches share a task if their calls take no longer than this together, by the slowest call of the wave before.
TASK_SECONDS = 0.5

MOST_OF_A_TASK = 25  # batches


class ResolverError(RuntimeError):
    """Some calls failed; the answers to all others are stored."""


@dataclass(frozen=True)
class Asked:
    """What a run did: calls made, and pairs stored."""

    calls: int
    stored: int


def resolve_into(
    values: DataFrame,
    path: str,
    domain: str,
    resolver: Resolver,
    finish: Finish = open_answers,
    batch_size: int = BATCH_SIZE,
    at_once: int = AT_ONCE,
    attempts: int = 1,
) -> Asked:
    """Ask ``resolver`` for the ``dirty`` values that ``domain`` of the mapping at ``path`` lacks, and store the answers.

    ``finish`` adds the column ``clean`` to the answers; a null one is not
    stored. ``at_once`` bounds the calls under way at a time, besides the cores
    there are. After a wave with failed calls no further one begins, and a
    ResolverError tells how many failed, and why the first did.
    """
    spark = values.sparkSession
    known = read_mapping(spark, path, domain)
    of_a_folder = at_once * max(1, AT_ONCE // at_once)  # whole waves
    batches = batches_of(only_new(values.select("dirty"), known), batch_size)
    batches = batches.withColumn("folder", F.floor(F.col("batch") / of_a_folder)).repartition("folder")
    batches = stage(batches, "batches", "folder")
    total = batches.count()
    calls = stored = 0
    of_a_task = 1
    for begin in range(0, total, at_once):
        end = min(begin + at_once, total)
        wave = batches.where((F.col("folder") == begin // of_a_folder) & F.col("batch").between(begin, end - 1))
        task = F.floor((F.col("batch") - begin) / of_a_task).cast("int")
        wave = wave.repartitionById(-(-(end - begin) // of_a_task), task)
        seen = Observation()
        failed = F.col("error").isNotNull()
        answered = finish(ask(wave, resolver, attempts)).observe(
            seen,
            F.count_if(failed).alias("failed"),
            F.min_by("error", F.when(failed, F.col("batch"))).alias("first"),
            F.count_if(F.col("clean").isNotNull() & ~failed).alias("stored"),
            F.max("seconds").alias("slowest"),
        )
        write_pairs(answered.where(~failed & F.col("clean").isNotNull()), path, domain, as_tasks_end=True)
        calls, stored = calls + end - begin, stored + seen.get["stored"]
        of_a_task = _batches_of_a_task(seen.get["slowest"])
        if seen.get["failed"]:
            raise ResolverError(
                f"{seen.get['failed']} of {calls} calls for {domain} failed, {total - calls} of {total} were not made; "
                f"{stored} answers are stored, a rerun asks for the others. First failure: {seen.get['first']}"
            )
    return Asked(calls, stored)


def _batches_of_a_task(slowest: float) -> int:
    """How many batches a task gets if a call takes ``slowest`` seconds; one that takes long is a task of its own."""
    return max(1, min(MOST_OF_A_TASK, int(TASK_SECONDS / max(slowest, 1e-9))))
