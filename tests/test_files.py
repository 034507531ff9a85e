import datetime as dt
from pathlib import Path

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from clearbook import schemas
from clearbook.operators import breakdown, measures, pareto, profile, quality, summary, triage, weekly
from clearbook.plans import analysis, cleaning, registry, reporting
from clearbook.operators.measures import to_measures
from clearbook.sources import files, publication, staging, star


def raw_rows(spark, rows):
    """Raw transactions from (customer, region, segment, date, revenue) tuples."""
    data = [(f"T{i}", c, r, s, "sku", d, "1", v, "rep", None) for i, (c, r, s, d, v) in enumerate(rows)]
    return spark.createDataFrame(data, schemas.RAW)


RAW = [
    ("Acme Industrial Corp", "NE", "Paper", "2024-01-02", "100.00"),
    ("Acme Industrial Corp", "Northeast", "P&P", "01/09/2024", "$1,000.50"),
    ("ACME INDUSTRIAL CORP", "N.E.", "Mining", "16/01/2024", "-20.00"),
    ("Tidewater Chemical Co", "Pacific", "chem", "Jan 23, 2024", "50.25"),
    ("Tidewater Chemical C", "W", "Chemicals", "garbage", None),
    ("Tidewater Chemical Co", "W", "Chemicals", "23-Jan-2024", "x"),
]


def test_raw_csv_round_trip_and_missing_tokens(spark, tmp_path):
    values = ['a,b', 'say "hi"', "two\nlines", "  blanks  ", "NA", "null", "None", "n/a", "", "nan", "Nancy"]
    rows = [(str(i), v, None, None, None, None, None, None, None, None) for i, v in enumerate(values)]
    files.write_csv(spark.createDataFrame(rows, schemas.RAW), str(tmp_path / "raw"))
    found = files.read_raw_csv(spark, str(tmp_path / "raw"), multi_line=True).collect()
    by_id = {int(r.transaction_id): r.customer_name for r in found}
    assert [by_id[i] for i in range(len(values))] == values[:4] + [None] * 6 + ["Nancy"]
    kept = files.read_raw_csv(spark, str(tmp_path / "raw"), missing_tokens=[""], multi_line=True)
    assert kept.where("customer_name = 'NA'").count() == 1
    # a quoted line break cuts a record in two: loud, also where few columns are asked for
    for columns in (["transaction_id"], schemas.RAW_COLUMNS):
        with pytest.raises(Exception, match="(?i)malformed"):
            files.read_raw_csv(spark, str(tmp_path / "raw")).select(columns).collect()


def write_text(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


def test_csv_columns_are_bound_by_name(spark, tmp_path):
    header = list(reversed(schemas.RAW_COLUMNS)) + ["more"]
    write_text(tmp_path / "raw", "a.csv", ",".join(header) + "\n" + ",".join(f"the {name}" for name in header) + "\n")
    row = files.read_raw_csv(spark, str(tmp_path / "raw")).first()
    assert row.asDict() == {name: f"the {name}" for name in schemas.RAW_COLUMNS}
    write_text(tmp_path / "raw", "b.csv", ",".join(schemas.RAW_COLUMNS + ["more"]) + "\n" + ",".join("x" * 11) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_raw_csv(spark, str(tmp_path / "raw")).collect()


def test_a_missing_csv_column_is_named(spark, tmp_path):
    short = [name for name in schemas.RAW_COLUMNS if name != "region"]
    write_text(tmp_path / "raw", "a.csv", ",".join(short) + "\n" + ",".join("x" for _ in short) + "\n")
    with pytest.raises(ValueError, match="region"):
        files.read_raw_csv(spark, str(tmp_path / "raw"))


def test_damaged_records_are_set_aside(spark, tmp_path):
    names = ["a", "b c", "n"]
    header = 'a,"b c",n'
    good = ["1,x,5", '2,"x, y",6', '"3","say ""hi""",7', "4,,", '5,z,"8"', "6,  blanks  ,9", "7,NA,x"]
    bad = ["8,short", "9,x,5,long", '10,"cut', 'in two",5', '11,x,"cut', 'at the end"', "lonely"]
    write_text(tmp_path / "raw", "a.csv", "\n".join([header, *good[:4], *bad[:3], "", " "]) + "\n")
    write_text(tmp_path / "raw", "b.csv", "\r\n".join([header, *bad[3:], *good[4:], header]) + "\r\n")
    schema = "n int, `b c` string, a string"
    scan = files.scan_csv(spark, str(tmp_path / "raw"), schema, missing_tokens=["NA"], tolerated=0.6)
    assert scan.rows.columns == ["n", "b c", "a"] and set(names) == set(scan.rows.columns)
    assert sorted(map(tuple, scan.rows.collect()), key=lambda r: r[2]) == [
        (5, "x", "1"), (6, "x, y", "2"), (7, 'say "hi"', "3"), (None, None, "4"), (8, "z", "5"), (9, "  blanks  ", "6"),
        (None, None, "7"),
    ]
    assert sorted(r.record for r in scan.rejected.collect()) == sorted(bad)
    assert (scan.n_rows, scan.n_rejected) == (len(good), len(bad))
    problems = {r.record: r.problem for r in scan.rejected.collect()}
    assert problems["8,short"] == "number of fields" and problems['11,x,"cut'] == "open quote"
    assert {Path(r.file).name for r in scan.rejected.where("record = 'lonely'").collect()} == {"b.csv"}
    with pytest.raises(files.DamagedRecords, match="7 of 14 records"):
        files.scan_csv(spark, str(tmp_path / "raw"), schema, tolerated=0.4)
    with pytest.raises(ValueError, match="missing.*other"):
        files.scan_csv(spark, str(tmp_path / "raw"), "other string")
    with pytest.raises(FileNotFoundError, match="first"):
        files.scan_csv(spark, str(tmp_path / "no"), schema, "Write it first.")
    write_text(tmp_path / "raw", "c.csv", 'n,"b c",a\n1,2,3\n')
    with pytest.raises(ValueError, match="c.csv has not the header"):
        files.scan_csv(spark, str(tmp_path / "raw"), schema, tolerated=1.0)


def test_scans_without_damage_or_without_rows(spark, tmp_path):
    rows = [(str(i), f'a "{i}", b', " x ", None, None, None, None, None, None, "é") for i in range(50)]
    raw = spark.createDataFrame(rows, schemas.RAW).repartition(4)
    files.write_csv(raw, str(tmp_path / "raw"))
    scan = files.scan_raw_records(spark, str(tmp_path / "raw"))
    assert sorted(scan.rows.collect()) == sorted(files.read_raw_csv(spark, str(tmp_path / "raw")).collect())
    assert (scan.n_rows, scan.n_rejected, scan.rejected.count()) == (50, 0, 0)
    write_text(tmp_path / "none", "a.csv", ",".join(schemas.RAW_COLUMNS) + "\n")
    assert files.scan_raw_records(spark, str(tmp_path / "none")).rows.count() == 0


def test_the_cleaning_job_counts_rejected_records(spark, tmp_path):
    files.write_csv(raw_rows(spark, RAW).coalesce(1), str(tmp_path / "raw"))
    write_text(tmp_path / "raw", "more.csv", ",".join(schemas.RAW_COLUMNS) + "\nT9,half a record\n")
    paths = [str(tmp_path / name) for name in ("clean", "report")]
    before = staged_tables(spark)
    with pytest.raises(files.DamagedRecords):
        cleaning.run_cleaning_file(spark, str(tmp_path / "raw"), *paths)
    report = cleaning.run_cleaning_file(
        spark, str(tmp_path / "raw"), *paths, rejected_path=str(tmp_path / "rejected"), tolerated=0.2
    ).first()
    assert (report.rows_processed, report.records_rejected) == (6, 1)
    assert spark.read.parquet(str(tmp_path / "rejected")).first().record == "T9,half a record"
    assert spark.read.parquet(paths[0]).count() == 6
    assert staged_tables(spark) == before


def test_clean_csv_values_that_are_none(spark, tmp_path):
    names = schemas.CLEAN.fieldNames()
    values = {"revenue_usd_clean": ["1.5", "NaN", "inf", "-Infinity", "x", ""], "order_date_clean": ["2024-01-02", "soon", "", "", "", ""]}
    lines = [",".join(values.get(name, ["t"] * 6)[i] for name in names) for i in range(6)]
    write_text(tmp_path / "clean", "a.csv", "\n".join([",".join(names), *lines]) + "\n")
    rows = files.read_clean_csv(spark, str(tmp_path / "clean")).collect()
    assert [r.revenue_usd_clean for r in rows] == [1.5] + [None] * 5
    assert [r.order_date_clean for r in rows] == [dt.date(2024, 1, 2)] + [None] * 5
    parquet = spark.createDataFrame(
        [("c", "r", "s", dt.date(2024, 1, 1), float("nan"))],
        "customer_name_clean string, region_clean string, industry_segment_clean string, order_date_clean date, "
        "revenue_usd_clean double",
    )
    parquet.write.parquet(str(tmp_path / "parquet"))
    assert files.read_clean(spark, str(tmp_path / "parquet")).first().revenue_usd_clean is None


def staged_tables(spark):
    root = Path(staging.shared_folder(spark).removeprefix("file:")) / "clearbook"
    return {p.name for p in root.iterdir()} if root.exists() else set()


def test_jobs_delete_what_they_staged(spark, tmp_path, eight_rows):
    before = staged_tables(spark)
    paths = [str(tmp_path / name) for name in ("clean", "report", "mapping")]
    cleaning.run_cleaning(raw_rows(spark, RAW), *paths)
    cleaning.run_cleaning(raw_rows(spark, RAW), *paths[:2])
    rows = to_measures(eight_rows)
    analysis.run_analysis(rows, rows, str(tmp_path / "results"))
    assert staged_tables(spark) == before


def test_resolvers_in_the_job(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def regions(batch):
        calls.add(len(batch))
        return {"NE": "Northeast", "Pacific": "The Pacific", "W": "West"}

    def customers(batch):
        calls.add(len(batch))
        return {name: "Acme" for name in batch if name.lower().startswith("acme")}

    arguments = (raw_rows(spark, RAW), *(str(tmp_path / name) for name in ("clean", "report", "mapping")))
    resolvers = {"regions": regions, "customers": customers}
    report = cleaning.run_cleaning(*arguments, resolvers=resolvers).first()
    rows = files.read_clean(spark, str(tmp_path / "clean")).orderBy("transaction_id").collect()
    # answers outside the vocabulary, and values without one, fall back to containment in order
    assert [r.region_clean for r in rows] == ["Northeast", "Northeast", "Northeast", "Northeast", "West", "West"]
    assert [r.customer_name_clean for r in rows] == ["Acme"] * 3 + ["Tidewater Chemical Co", "Tidewater Chemical C", "Tidewater Chemical Co"]
    assert [r.industry_segment_clean for r in rows][2:4] == ["Mining", "Chemical Processing"]
    assert report.method == "resolver: customers, regions" and calls.value == 9
    cleaning.run_cleaning(*arguments, resolvers=resolvers)
    assert calls.value == 9
    with pytest.raises(ValueError, match="mapping_path"):
        cleaning.run_cleaning(*arguments[:3], resolvers=resolvers)


def test_odd_amounts_neither_stop_nor_distort_the_analysis(spark):
    amounts = [10.0, 1e26, float("nan"), float("inf"), float("-inf"), None, -5.0, 1e11, 2e20]
    rows = [(str(i), "c", "r", "s", dt.date(2024, 1, 1), a) for i, a in enumerate(amounts)]
    clean = spark.createDataFrame(
        rows, "transaction_id string, customer_name_clean string, region_clean string, industry_segment_clean string, "
        "order_date_clean date, revenue_usd_clean double",
    )
    counts = measures.exclusion_counts(clean).first().asDict()
    assert counts == {"rows": 9, "null_revenue": 4, "oversized_revenue": 1, "negative_revenue": 1, "analyzable": 3}
    refunds = measures.exclusion_counts(clean, include_refunds=True).first()
    assert (refunds.negative_revenue, refunds.analyzable) == (0, 4)
    assert {r.transaction_id for r in measures.analyzable(clean).collect()} == {"0", "7", "8"}
    for frame in (clean, measures.analyzable(clean)):
        row = pareto.customer_pareto(to_measures(frame)).first()
        assert row.revenue == (2e20 + 1e11 + 5 if frame is clean else 2e20 + 1e11 + 10)
        ordinary = frame.where("transaction_id <> '8'")
        assert pareto.customer_pareto(to_measures(ordinary)).first().revenue == (1e11 + 5 if frame is clean else 1e11 + 10)


def test_missing_files_are_named_with_a_hint(spark, tmp_path):
    for read in (files.read_clean, files.read_results, files.read_weekly_csv, files.read_raw_csv):
        with pytest.raises(FileNotFoundError, match="absent not found. .* first"):
            read(spark, str(tmp_path / "absent"))


def test_missing_columns_are_named(spark, tmp_path):
    spark.range(1).select(F.lit("x").alias("region_clean")).write.parquet(str(tmp_path / "clean"))
    with pytest.raises(ValueError, match="customer_name_clean"):
        files.read_clean(spark, str(tmp_path / "clean"))


def test_staging_goes_to_the_shared_folder(spark):
    folder = staging.shared_folder(spark)
    staged = staging.stage(spark.range(5), "numbers")
    assert staged.count() == 5
    assert all(folder in f for f in staged.inputFiles())
    assert spark.conf.get("spark.checkpoint.dir").rstrip("/") == folder


def test_cleaning_job(spark, tmp_path):
    out, report = str(tmp_path / "clean"), str(tmp_path / "report")
    document = cleaning.run_cleaning(raw_rows(spark, RAW), out, report, str(tmp_path / "mapping"), ratio=2.0).first()
    clean = files.read_clean(spark, out).orderBy("transaction_id").collect()
    assert [r.customer_name_clean for r in clean] == ["Acme Industrial Corp"] * 3 + ["Tidewater Chemical Co"] * 3
    assert [r.region_clean for r in clean] == ["Northeast"] * 3 + ["West"] * 3
    assert [r.industry_segment_clean for r in clean] == ["Pulp & Paper"] * 2 + ["Mining"] + ["Chemical Processing"] * 3
    days = [d and d.isoformat() for d in (r.order_date_clean for r in clean)]
    assert days == ["2024-01-02", "2024-01-09", "2024-01-16", "2024-01-23", None, "2024-01-23"]
    assert [r.revenue_usd_clean for r in clean] == [100.0, 1000.5, -20.0, 50.25, None, None]
    assert document.before.asDict() == {
        "rows": 6, "unique_customers": 4, "unique_regions": 5, "unique_segments": 5, "null_revenues": 1,
    }
    assert document.after.asDict() == {
        "unique_customers": 2, "unique_regions": 2, "unique_segments": 3, "null_revenues": 2, "unparseable_dates": 1,
    }
    assert document.reductions.asDict() == {"customers_pct": 50.0, "regions_pct": 60.0, "segments_pct": 40.0}
    assert cleaning.load_clean(spark, out).count() == 3
    assert cleaning.load_clean(spark, out, include_refunds=True).count() == 4


def test_blank_texts_stay_as_they_are(spark):
    rows = [(" ", " ", None, None, None), (None, None, "", "", ""), ("Acme Works", "W", "Wood", "", "")]
    from clearbook.operators.cleaning import clean_transactions

    found = clean_transactions(raw_rows(spark, rows)).orderBy("transaction_id").collect()
    assert [r.customer_name_clean for r in found] == [" ", None, "Acme Works"]
    assert [r.region_clean for r in found] == [" ", None, "West"]
    assert [r.industry_segment_clean for r in found] == [None, "", "Wood Products"]


def test_analysis_report_and_delivery(spark, tmp_path, eight_rows):
    results, log = str(tmp_path / "results"), str(tmp_path / "log")
    reports = str(tmp_path / "reports")
    rows = to_measures(eight_rows)
    analysis.run_analysis(rows, rows, results)
    document = files.read_results(spark, f"{results}/analysis_results").first()
    assert [r.customer_name_clean for r in document.top_customers] == ["A", "B", "C"]
    assert [r.region_clean for r in document.region_breakdown] == ["East", "West"]
    assert [r.industry_segment_clean for r in document.segment_breakdown] == ["Paper", "Mining"]
    assert document.dataset_summary.total_revenue == 1000.0 and document.weekly_summary.weeks_covered == 4

    arguments = (spark, f"{results}/analysis_results", f"{results}/weekly_revenue", reports, log)
    assert len(reporting.deliver(*arguments)) == 8
    reporting.deliver(*arguments)  # the same date again replaces, and is logged again
    assert spark.read.parquet(f"{reports}/customers").count() == 3
    tiles = {r.label: r.value for r in spark.read.parquet(f"{reports}/kpi_tiles").collect()}
    assert tiles["TOTAL REVENUE"] == "$1,000" and tiles["80/20 TIER SIZE"] == "1 customers"
    assert spark.read.parquet(f"{reports}/pareto_curve").where("threshold_line = 0.8").count() == 3
    entries = files.read_delivery_log(spark, log).collect()
    assert [e.report_path for e in entries] == ["weekly_report_2024-01-23"] * 2
    catalog = publication.report_catalog(publication.report_files(spark, reports)).collect()
    assert {(r.year, r.report_date.isoformat()) for r in catalog} == {(2024, "2024-01-23")} and len(catalog) == 8
    assert "customers_2024-01-23" in {r.name for r in catalog}
    assert all(r.size.endswith(" KB") and r.bytes > 0 for r in catalog)


def test_analysis_adds_up_in_one_pass(spark, tmp_path, monkeypatch):
    """What is staged has a row for each value, customer of a region and day, not for each segment of a customer."""
    names = (
        "transaction_id customer_name_clean region_clean industry_segment_clean revenue_usd_clean order_date_clean"
    ).split()
    amounts = [float(i) for i in range(396)] + [None, 2e9, -3.5, float("nan")]
    rows = [
        (
            None if i % 7 == 0 else f"T{i}", None if i % 20 == 0 else f"C{i % 20}", None if i % 9 == 0 else f"R{i % 3}",
            None if i % 31 == 0 else f"S{i // 20 % 10}", amount, None if i % 13 == 0 else dt.date(2024, 1, 1 + i % 28),
        )
        for i, amount in enumerate(amounts)
    ]
    measured = to_measures(spark.createDataFrame(rows, names))
    staged, plans, stage = {}, {}, analysis.stage

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        staged[name] = stage(df, name)
        return staged[name]

    monkeypatch.setattr(analysis, "stage", noted)
    measured.write.parquet(str(tmp_path / "measured"))
    measured = spark.read.parquet(str(tmp_path / "measured"))
    separate = analysis.analyze(measured, measured)
    together = analysis.analyze(measured)
    by_value = {(r[2], r[1]) for r in rows}, {r[3] for r in rows}, {r[5] for r in rows}
    assert staged["cube"].count() == sum(map(len, by_value)) < len({(r[1], r[2], r[3]) for r in rows})
    assert plans["cube"].count("FileScan") == 1
    assert not any("measured" in plan for name, plan in plans.items() if name != "cube")

    def same(found, expected):
        assert found.columns == expected.columns
        assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))

    for result in (separate, together):
        same(result.dataset, summary.dataset_summary(measured))
        same(result.customers, pareto.customer_pareto(measured))
        same(result.segments, breakdown.segment_breakdown(measured))
        same(result.regions, breakdown.region_breakdown(measured))
        same(result.weeks, weekly.weekly_revenue(measured))
    nothing = analysis.analyze(measured.limit(0))
    same(nothing.dataset, summary.dataset_summary(measured.limit(0)))
    assert nothing.segments.count() == nothing.customers.count() == nothing.weeks.count() == 0


def test_breakdowns_are_published_whole(spark, tmp_path):
    rows = [(f"T{i}", f"C{i % 3}", f"R{i % 60}", f"S{i}", 10.0 + i, dt.date(2024, 1, 1 + i % 20)) for i in range(80)]
    names = (
        "transaction_id customer_name_clean region_clean industry_segment_clean revenue_usd_clean order_date_clean"
    ).split()
    measured = to_measures(spark.createDataFrame(rows, names))
    results, reports = str(tmp_path / "results"), str(tmp_path / "reports")
    analysis.run_analysis(measured, measured, results)
    reporting.deliver(spark, f"{results}/analysis_results", f"{results}/weekly_revenue", reports, str(tmp_path / "log"))
    segments = publication.latest(spark, f"{reports}/segments")
    assert {r.industry_segment_clean: r.revenue for r in segments.collect()} == {r[3]: r[4] for r in rows}
    assert publication.latest(spark, f"{reports}/regions").count() == 60
    reporting.run_report(
        spark, f"{results}/analysis_results", f"{results}/weekly_revenue", str(tmp_path / "again"),
        f"{results}/segment_breakdown", f"{results}/region_breakdown",
    )
    assert spark.read.parquet(str(tmp_path / "again" / "segments")).count() == 80


def test_publication_keeps_other_dates(spark, tmp_path):
    for day, value in [("2023-03-15", 1), ("2024-12-31", 2), ("2024-01-07", 3), ("2023-03-15", 4)]:
        report = spark.createDataFrame([(value,)], "value int")
        path = publication.publish(report, str(tmp_path), "weekly", F.lit(day).cast("date"))
    assert {r.value for r in spark.read.parquet(path).collect()} == {2, 3, 4}
    # the newest date, not the last one published
    assert [(r.value, r.report_date) for r in publication.latest(spark, path).collect()] == [(2, dt.date(2024, 12, 31))]
    years = publication.catalog_by_year(publication.report_files(spark, str(tmp_path))).collect()
    assert [(r.year, r.reports) for r in years] == [(2024, 2), (2023, 1), (None, 3)]
    assert years[2].bytes == years[0].bytes + years[1].bytes


def test_a_damaged_log_line_spoils_no_other(spark, tmp_path):
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "a.json").write_text(
        '{"report_path": "one", "upload": {"status": "skipped"}}\n{"report_path": "tw\n{"report_path": "three"}\n'
    )
    rows = files.read_delivery_log(spark, str(tmp_path / "log")).collect()
    assert sorted(str(r.report_path) for r in rows) == ["None", "one", "three"]
    assert [r.corrupt_record for r in rows if r.report_path is None] == ['{"report_path": "tw']


def test_quality_checks(spark):
    rows = [(f"customer {i}", f"region {i % 20}", "s", "2024-1-1" + "0" * (i % 3), None if i % 20 == 0 else "$1") for i in range(100)]
    raw = raw_rows(spark, rows)
    assert all(r.passed for r in quality.quality_checks(raw, 100).collect())
    failed = {r.check_name for r in quality.quality_checks(raw.limit(10), 100).collect() if not r.passed}
    assert {"row_count", "messy_customers", "messy_regions", "null_revenue_share", "all_passed"} >= failed >= {
        "row_count", "messy_customers", "messy_regions", "all_passed",
    }
    columns = {r.column_name: (r.present, r.filled_rows) for r in quality.column_check(raw.drop("region")).collect()}
    assert columns["region"] == (False, 0) and columns["revenue_usd"] == (True, 95) and columns["notes"] == (True, 0)


def test_profile_counts_rows_not_combinations(spark):
    found = profile.cleaning_profile(raw_rows(spark, RAW * 3)).first()
    assert (found.rows, found.before_null_revenues, found.after_null_revenues, found.unparseable_dates) == (18, 3, 6, 3)
    assert profile.dirty_triples(raw_rows(spark, RAW * 3)).count() == 6


def test_error_triage(spark):
    messages = [
        "Server returned 401 Unauthorized", "403 Forbidden", "404 Not Found: site URL", "Failed to resolve hostname",
        "wild error", "x" * 300,
    ]
    df = spark.createDataFrame([(m,) for m in messages], "message string")
    found = triage.triage(df, "message").collect()
    assert [r.cause for r in found] == ["authentication", "permission", "site", "network", "other", "other"]
    assert all(r.hint for r in found) and len(found[5].reason) == 200


def test_whole_raw_tables_are_written_compressed(spark):
    path = registry._damaged_csv(spark, SMALL)
    lines = spark.read.text(path)
    assert all(name.endswith(".csv.gz") for name in lines.inputFiles())
    n = star.table(spark, SMALL, "lineitem").count()
    scan = files.scan_raw_records(spark, path, tolerated=0.6)
    assert scan.n_rows == scan.rows.count() and scan.n_rejected == scan.rejected.count()
    # every line is a row or rejected; two damaged kinds of records are two lines each
    assert n < scan.n_rows + scan.n_rejected < 2 * n
    assert all(name.endswith(".zstd.parquet") for name in scan.rows.inputFiles() + scan.rejected.inputFiles())
    # folders for rows and rejected records would have each task sort all it reads
    assert not any("kind=" in name for name in scan.rows.inputFiles())
