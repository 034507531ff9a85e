import os
import time
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from clearbook.operators import resolver
from clearbook.plans.cleaning import run_cleaning
from clearbook.schemas import RAW
from clearbook.sources import answers
from clearbook.sources.answers import ResolverError, resolve_into
from clearbook.sources.mapping_table import append_mapping, read_mapping
from clearbook.sources.staging import stage


@pytest.fixture
def values(spark):
    """158 values in 100 partitions, some of them repeated, and a null."""
    names = [f"name {i:03}" for i in range(158)]
    rows = [(n,) for n in names + names[:20] + [None]]
    return spark.createDataFrame(rows, "dirty string").repartition(100)


def noting(folder, failing=lambda batch: False):
    """A resolver that leaves a file for every call, and fails for some."""

    def answer(batch):
        Path(folder, f"{batch[0]}-{len(batch)}-{time.time_ns()}").touch()
        if failing(batch):
            raise TimeoutError("no answer")
        return {value: value.upper() for value in batch}

    return answer


def calls(folder):
    return sorted(tuple(p.name.split("-")[:2]) for p in Path(folder).iterdir())


def test_batches_are_dense_and_in_order(values, separate_partitions):
    rows = sorted(resolver.batch_sizes(resolver.batches_of(values)).collect())
    assert [tuple(r) for r in rows] == [
        (0, 50, "name 000", "name 049"),
        (1, 50, "name 050", "name 099"),
        (2, 50, "name 100", "name 149"),
        (3, 8, "name 150", "name 157"),
    ]
    assert resolver.batches_of(values.where("dirty IS NULL")).count() == 0


def test_one_call_for_each_batch(values, tmp_path, separate_partitions):
    found = resolver.resolve_batches(values, noting(tmp_path)).collect()
    assert len(found) == 158 and all(r.clean == r.dirty.upper() for r in found)
    assert calls(tmp_path) == [("name 000", "50"), ("name 050", "50"), ("name 100", "50"), ("name 150", "8")]


def test_a_failure_without_a_store_stops_the_job(values, tmp_path):
    with pytest.raises(Exception, match="TimeoutError: no answer"):
        resolver.resolve_batches(values, noting(tmp_path, lambda batch: True)).collect()


@pytest.mark.parametrize("at_once", [1, 2, 4, 1000])
def test_a_rerun_asks_for_what_is_missing(spark, values, tmp_path, at_once):
    asked, path = tmp_path / "asked", str(tmp_path / "mapping")
    asked.mkdir()
    failing = noting(asked, lambda batch: len(batch) == 8)
    with pytest.raises(ResolverError, match="1 of 4 calls for names failed.*150 answers are stored.*no answer"):
        resolve_into(values, path, "names", failing, at_once=at_once)
    assert read_mapping(spark, path, "names").count() == 150 and len(calls(asked)) == 4
    again = resolve_into(values, path, "names", noting(asked), at_once=at_once)
    assert (again.calls, again.stored) == (1, 8)
    assert calls(asked)[-2:] == [("name 150", "8")] * 2 and len(calls(asked)) == 5
    assert {(r.dirty, r.clean) for r in read_mapping(spark, path, "names").collect()} == {
        (f"name {i:03}", f"NAME {i:03}") for i in range(158)
    }
    assert resolve_into(values, path, "names", noting(asked)).calls == 0
    # nothing is stored twice
    assert spark.read.parquet(path).count() == 158


def test_no_wave_begins_after_a_failure(spark, values, tmp_path):
    asked, path = tmp_path / "asked", str(tmp_path / "mapping")
    asked.mkdir()
    with pytest.raises(ResolverError, match="1 of 1 calls for names failed, 3 of 4 were not made; 0 answers"):
        resolve_into(values, path, "names", noting(asked, lambda batch: batch[0] == "name 000"), at_once=1)
    assert len(calls(asked)) == 1 and read_mapping(spark, path, "names").count() == 0


def test_a_lost_worker_loses_its_own_batch_alone(spark, values, tmp_path):
    path = str(tmp_path / "mapping")

    def dying(batch):
        if len(batch) == 8:
            time.sleep(8)  # the others end meanwhile
            os._exit(1)
        return {value: value.upper() for value in batch}

    with pytest.raises(Exception) as raised:
        resolve_into(values, path, "names", dying)
    assert not isinstance(raised.value, ResolverError)
    assert read_mapping(spark, path, "names").count() == 150
    asked = tmp_path / "asked"
    asked.mkdir()
    assert resolve_into(values, path, "names", noting(asked)).stored == 8
    assert calls(asked) == [("name 150", "8")]


def test_fast_calls_share_tasks(spark, values, tmp_path):
    asked, path = tmp_path / "asked", tmp_path / "mapping"
    asked.mkdir()
    done = resolve_into(values, str(path), "names", noting(asked), batch_size=2, at_once=20)
    assert (done.calls, done.stored) == (79, 158)
    # each batch is still one call of its own
    assert calls(asked) == [(f"name {i:03}", "2") for i in range(0, 158, 2)]
    # the first wave has a task for each batch, as nothing is known of the calls; the other three have few tasks
    assert 20 < len(list(path.rglob("*.parquet"))) <= 20 + 3 * 5
    assert spark.read.parquet(str(path)).count() == 158


def test_slow_calls_are_tasks_of_their_own(spark, values, tmp_path):
    def slow(batch):
        time.sleep(answers.TASK_SECONDS + 0.1)
        return {value: value.upper() for value in batch}

    path = tmp_path / "mapping"
    assert resolve_into(values, str(path), "names", slow, batch_size=20, at_once=4).calls == 8
    assert len(list(path.rglob("*.parquet"))) == 8


def test_a_task_has_as_many_batches_as_half_a_second_answers():
    found = [answers._batches_of_a_task(seconds) for seconds in (100.0, 0.6, 0.26, 0.1, 0.01, 0.0)]
    assert found == [1, 1, 1, 5, 25, 25]


@pytest.mark.parametrize("at_once", [1, 3, 200, 1000])
def test_a_wave_reads_its_own_folder(spark, values, tmp_path, monkeypatch, at_once):
    staged = []

    def noted(*args):
        staged.append(stage(*args))
        return staged[-1]

    monkeypatch.setattr(answers, "stage", noted)
    monkeypatch.setattr(answers, "AT_ONCE", 4)
    many = spark.range(60).select(F.col("id").cast("string").alias("dirty"))
    # nothing is asked, as the first wave fails
    with pytest.raises(ResolverError):
        resolve_into(many, str(tmp_path / "mapping"), "names", noting(tmp_path, lambda batch: True), batch_size=2, at_once=at_once)
    [batches] = staged
    folders = batches.groupBy("folder").agg(F.min("batch").alias("first"), F.count("*").alias("n")).orderBy("folder").collect()
    size = {1: 4, 3: 3, 200: 200, 1000: 1000}[at_once]
    assert [(r["first"], r["n"]) for r in folders] == [(i, min(size, 30 - i)) for i in range(0, 30, size)]
    assert len(batches.inputFiles()) == len(folders)


def test_attempts(spark, values, tmp_path):
    asked = tmp_path / "asked"
    asked.mkdir()

    answer, refuse = noting(asked), noting(asked, lambda batch: True)

    def failing_first(batch):
        return answer(batch) if list(asked.glob(f"{batch[0]}-*")) else refuse(batch)

    done = resolve_into(values, str(tmp_path / "mapping"), "names", failing_first, attempts=2)
    assert (done.calls, done.stored) == (4, 158)
    assert set(Counter(calls(asked)).values()) == {2}


def test_stored_pairs_win_and_unanswered_values_get_defaults(spark, tmp_path):
    path = str(tmp_path / "mapping")
    append_mapping(spark.createDataFrame([("a", "first")], "dirty string, clean string"), path, "names")
    values = spark.createDataFrame([("a",), ("b co",), ("c",)], "dirty string")
    done = resolve_into(values, path, "names", lambda batch: {"a": "second", "c": "C!"})
    assert (done.calls, done.stored) == (1, 2)
    assert {(r.dirty, r.clean) for r in read_mapping(spark, path, "names").collect()} == {
        ("a", "first"), ("b co", "B Co"), ("c", "C!"),
    }


def test_the_cleaning_job_goes_on_where_it_stopped(spark, tmp_path):
    paths = [str(tmp_path / name) for name in ("clean", "report", "mapping")]
    rows = [(f"T{i}", f"Name {i:03}", "NE", "Paper", "sku", "2024-01-02", "1", "5.00", "rep", None) for i in range(120)]
    raw = spark.createDataFrame(rows, RAW)
    asked = tmp_path / "asked"
    asked.mkdir()
    down = noting(asked, lambda batch: batch[0] == "Name 050")
    with pytest.raises(ResolverError):
        run_cleaning(raw, *paths, resolvers={"customers": down})
    assert not Path(paths[0]).exists()
    run_cleaning(raw, *paths, resolvers={"customers": noting(asked)})
    assert calls(asked) == [("Name 000", "50"), ("Name 050", "50"), ("Name 050", "50"), ("Name 100", "20")]
    clean = spark.read.parquet(paths[0])
    assert clean.where(F.col("customer_name_clean") == F.upper("customer_name")).count() == 120
