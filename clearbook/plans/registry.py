"""The registered queries: every operator run over the whole provided tables."""

from __future__ import annotations

import contextlib
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearbook.functions import dates, numeric, text
from clearbook.functions.matching import match_closed, match_method
from clearbook.functions.vocabulary import REGION_SPELLINGS, REGIONS, SEGMENTS
from clearbook.operators import (
    breakdown,
    cleaning,
    containment,
    mapping,
    measures,
    names,
    pareto,
    profile,
    quality,
    quantiles,
    report_tables,
    resolver,
    summary,
    triage,
    weekly,
)
from clearbook.plans import analysis, reporting
from clearbook.plans.cleaning import load_clean, run_cleaning, run_cleaning_file
from clearbook.schemas import RAW_COLUMNS
from clearbook.sources import files, publication, star
from clearbook.sources.answers import ResolverError, resolve_into
from clearbook.sources.mapping_store import MappingStore
from clearbook.sources.mapping_table import append_mapping, read_mapping
from clearbook.sources.staging import fresh_path, stage

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Columns of the raw table that follow from line items and orders alone.
RAW_OF_TEXTS = ["transaction_id", "customer_name", "region", "industry_segment", "order_date", "revenue_usd"]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- revenue analytics over the star schema ---------------------------------


@query
def customer_pareto(spark, folder):
    return pareto.customer_pareto(star.customer_measures(spark, folder))


@query
def customer_revenue(spark, folder):
    return pareto.customer_revenue(star.customer_measures(spark, folder))


@query
def vip_customers(spark, folder):
    return pareto.vip_customers(customer_pareto(spark, folder))


@query
def top_customers(spark, folder):
    return pareto.top_customers(star.customer_measures(spark, folder))


@query
def pareto_summary(spark, folder):
    return pareto.pareto_summary(customer_pareto(spark, folder))


@query
def segment_breakdown(spark, folder):
    return breakdown.segment_breakdown(star.customer_measures(spark, folder))


@query
def region_breakdown(spark, folder):
    return breakdown.region_breakdown(star.customer_measures(spark, folder))


@query
def top_segments(spark, folder):
    return breakdown.top_rows(segment_breakdown(spark, folder))


@query
def top_regions(spark, folder):
    return breakdown.top_rows(region_breakdown(spark, folder))


@query
def all_breakdowns(spark, folder):
    """Three breakdowns and the total out of one pass over the measures."""
    rows = star.customer_measures(spark, folder).withColumn("last_digit", F.right(measures.CUSTOMER, F.lit(1)))
    return breakdown.breakdowns(rows, [measures.SEGMENT, measures.REGION, "last_digit"])


@query
def approximate_breakdown(spark, folder):
    """Customers of each region out of sketches that were made by region and segment, against the exact number."""
    rows = star.customer_measures(spark, folder)
    fine = measures.roll_up(rows, measures.REGION, measures.SEGMENT, sketched=[measures.CUSTOMER])
    about = measures.roll_up(fine, measures.REGION).withColumn("about", measures.distinct_estimate(measures.CUSTOMER))
    exact = rows.groupBy(F.col(measures.REGION).alias("region")).agg(F.count_distinct(measures.CUSTOMER).alias("customers"))
    joined = about.join(exact, F.col(measures.REGION).eqNullSafe(F.col("region")))
    within = F.abs(F.col("about") - F.col("customers")) <= 0.05 * F.col("customers")
    return joined.select(measures.REGION, "transactions", "customers", within.alias("estimate_within_5_percent"))


@query
def approximate_summary(spark, folder):
    """The summary without counting each customer; the few segments and regions are counted exactly even so."""
    rows = star.customer_measures(spark, folder)
    exact = rows.agg(F.count_distinct(measures.CUSTOMER)).scalar()
    about = summary.dataset_summary(rows, approximate=True)
    within = F.abs(F.col("unique_customers") - exact) <= 0.05 * exact
    return about.withColumn("customers_within_5_percent", within).drop("unique_customers")


@query
def typical_amounts(spark, folder):
    """Quantiles of amounts out of sketches by flag and status, united by flag, against their true ranks."""
    lines = star.table(spark, folder, "lineitem")
    sketches = quantiles.amount_sketches(lines, ["l_returnflag", "l_linestatus"], F.col("l_extendedprice"))
    shares = [0.1, 0.5, 0.9]
    found = quantiles.quantiles(quantiles.unite(sketches, "l_returnflag"), shares)
    # a sketch gives another quantile each time it is made, so the one that is judged is kept
    found = stage(found.select("*", F.posexplode("quantiles")).withColumnsRenamed({"pos": "place", "col": "value"}), "quantiles")
    asked = found.groupBy("l_returnflag").agg(F.map_from_entries(F.collect_list(F.struct("place", "value"))).alias("values"))
    below = [F.count_if(F.col("l_extendedprice") <= F.col("values")[i]).alias(f"below_{i}") for i in range(len(shares))]
    # a row for each flag
    ranks = lines.join(F.broadcast(asked), "l_returnflag").groupBy("l_returnflag").agg(*below)
    rank = F.array(*[f"below_{i}" for i in range(len(shares))])[F.col("place")] / F.col("priced_rows")
    share = F.array(*[F.lit(share) for share in shares])[F.col("place")]
    return found.join(ranks, "l_returnflag").select(
        "l_returnflag", "priced_rows", share.alias("share"), (F.abs(rank - share) <= 0.01).alias("rank_within_1_percent")
    )


@query
def weekly_revenue(spark, folder):
    return weekly.weekly_revenue(star.order_measures(spark, folder))


def _staged_weeks(spark, folder):
    return stage(weekly_revenue(spark, folder), "weeks")


@query
def weekly_summary(spark, folder):
    return weekly.weekly_summary(weekly_revenue(spark, folder))


@query
def weekly_trend(spark, folder):
    return weekly.trend(weekly_summary(spark, folder))


@query
def dataset_summary(spark, folder):
    return summary.dataset_summary(star.customer_measures(spark, folder))


# --- report tables -----------------------------------------------------------


@query
def kpi_tiles(spark, folder):
    # one pass over the orders feeds all three summaries
    orders = stage(star.order_measures(spark, folder), "orders")
    customers = stage(star.with_customers(spark, folder, orders), "customers")
    return report_tables.kpi_tiles(
        summary.dataset_summary(customers),
        pareto.pareto_summary(pareto.customer_pareto(customers)),
        weekly.weekly_summary(weekly.weekly_revenue(orders)),
    )


@query
def takeaway(spark, folder):
    return report_tables.takeaway(pareto_summary(spark, folder))


@query
def report_customers(spark, folder):
    return report_tables.report_customers(top_customers(spark, folder))


@query
def report_segments(spark, folder):
    return report_tables.report_breakdown(segment_breakdown(spark, folder))


@query
def report_regions(spark, folder):
    return report_tables.report_breakdown(region_breakdown(spark, folder))


@query
def weekly_report(spark, folder):
    return report_tables.weekly_report(_staged_weeks(spark, folder))


@query
def weekly_complete(spark, folder):
    return report_tables.weekly_complete(_staged_weeks(spark, folder))


@query
def pareto_curve(spark, folder):
    return report_tables.pareto_curve(top_customers(spark, folder))


# --- what needs cleaning ---------------------------------------------------------


@query
def dirty_names(spark, folder):
    """The spellings of customers and the key they are compared by."""
    values = mapping.distinct_values(star.dirty_texts(spark, folder), "customer_name")
    return values.select("dirty", text.name_key(F.col("dirty")).alias("name_key"), "n")


@query
def dirty_regions(spark, folder):
    return profile.vocabulary_share(star.dirty_texts(spark, folder), "region", REGIONS)


@query
def dirty_segments(spark, folder):
    return profile.vocabulary_share(star.dirty_texts(spark, folder), "industry_segment", SEGMENTS)


@query
def dirty_dates(spark, folder):
    return profile.text_shapes(star.dirty_texts(spark, folder), "order_date", dates.parse_date(F.col("order_date")))


@query
def dirty_revenue(spark, folder):
    return profile.text_shapes(star.dirty_texts(spark, folder), "revenue_usd", numeric.parse_money(F.col("revenue_usd")))


@query
def dirty_transactions(spark, folder):
    return profile.needs_cleaning(star.dirty_texts(spark, folder))


@query
def dirty_triples(spark, folder):
    return profile.dirty_triples(star.dirty_texts(spark, folder))


@query
def distinct_dirty(spark, folder):
    return mapping.distinct_values(star.dirty_texts(spark, folder), "region")


@query
def sorted_dirty(spark, folder):
    return mapping.sorted_values(star.dirty_texts(spark, folder), "industry_segment")


# --- scalar parsing ---------------------------------------------------------


@query
def parse_dates(spark, folder):
    value = F.col("order_date")
    return star.dirty_texts(spark, folder).select(
        "transaction_id",
        "order_date",
        dates.parse_date(value).alias("order_date_clean"),
        dates.is_ambiguous_date(value).alias("is_ambiguous"),
    )


@query
def parse_revenue(spark, folder):
    return star.dirty_texts(spark, folder).select(
        "transaction_id", "revenue_usd", numeric.parse_money(F.col("revenue_usd")).alias("revenue_usd_clean")
    )


@query
def title_case(spark, folder):
    values = mapping.distinct_values(star.dirty_texts(spark, folder), "customer_name")
    return values.select("dirty", text.title_case(F.col("dirty")).alias("title"), "n")


# --- standardisation ---------------------------------------------------------


def _half_mapping(spark):
    """A mapping that knows the spellings of the first three regions only."""
    pairs = [(spelling, entry) for entry in REGIONS[:3] for spelling in REGION_SPELLINGS[entry]]
    return spark.createDataFrame(pairs, "dirty string, clean string")


def _region_mapping(spark, folder):
    values = mapping.distinct_values(star.dirty_texts(spark, folder), "region")
    canonical = match_closed(F.col("dirty"), REGIONS, cleaning.REGION_ALIASES)
    return values.select("dirty", canonical.alias("clean"), "n")


@query
def apply_mapping(spark, folder):
    dirty = star.dirty_texts(spark, folder).select("transaction_id", "region")
    return mapping.apply_mapping(dirty, "region", _half_mapping(spark), "region_clean", "transaction_id")


@query
def repeated_pairs(spark, folder):
    """A mapping with repeated and conflicting pairs doubles no row."""
    pairs = _half_mapping(spark)
    conflicting = pairs.unionByName(pairs).unionByName(pairs.select("dirty", F.concat("clean", F.lit(" 2")).alias("clean")))
    dirty = star.dirty_texts(spark, folder).select("transaction_id", "region")
    return mapping.apply_mapping(dirty, "region", conflicting, "region_clean", "transaction_id")


@query
def unmapped_values(spark, folder):
    return mapping.unmapped_values(star.dirty_texts(spark, folder), "region", _half_mapping(spark))


@query
def merge_mapping(spark, folder):
    return mapping.merge_mapping(_half_mapping(spark), _region_mapping(spark, folder))


@query
def stored_mapping(spark, folder):
    path = fresh_path(spark, "mapping")
    append_mapping(_half_mapping(spark), path, "regions")
    append_mapping(_region_mapping(spark, folder), path, "regions")
    return read_mapping(spark, path, "regions")


@query
def bucketed_lookup(spark, folder):
    """Customer names looked up in a stored table in buckets that was filled in two steps and compacted."""
    dirty = star.dirty_texts(spark, folder).select("transaction_id", "customer_name")
    store = MappingStore(spark, fresh_path(spark, "store"), buckets=8)
    values = stage(mapping.distinct_values(dirty, "customer_name"), "values")
    upper = values.select("dirty", F.upper(text.strip(F.col("dirty"))).alias("clean"))
    store.append(upper.where(F.length("dirty") % 3 == 0), "customers")
    store.append(upper.where(F.length("dirty") % 3 != 1).withColumn("clean", F.lit("later")), "customers")
    store.compact()
    return mapping.apply_mapping(
        dirty, "customer_name", store.read("customers"), "customer_name_clean", "transaction_id", counts=values
    )


@query
def out_of_vocab(spark, folder):
    return mapping.out_of_vocabulary(star.dirty_texts(spark, folder), "region", REGIONS)


@query
def fallback_match(spark, folder):
    values = mapping.distinct_values(star.dirty_texts(spark, folder), "region")
    return values.select("dirty", text.fallback_match(F.col("dirty"), REGIONS).alias("fallback"), "n")


def _canonical(spark, folder, column, vocabulary, aliases):
    values = mapping.distinct_values(star.dirty_texts(spark, folder), column)
    dirty = F.col("dirty")
    return values.select(
        "dirty",
        match_closed(dirty, vocabulary, aliases).alias("clean"),
        match_method(dirty, vocabulary, aliases).alias("match_method"),
        "n",
    )


@query
def canonical_regions(spark, folder):
    return _canonical(spark, folder, "region", REGIONS, cleaning.REGION_ALIASES)


@query
def canonical_segments(spark, folder):
    return _canonical(spark, folder, "industry_segment", SEGMENTS, cleaning.SEGMENT_ALIASES)


@query
def canonical_customers(spark, folder):
    values = mapping.distinct_values(star.dirty_texts(spark, folder), "customer_name")
    return names.canonical_names(values)


def _mistyped_names(spark, folder):
    """Customer names with their number of rows: the name itself, and forms with one edit more each, each rarer."""
    name = F.col("c_name")

    def without(letters, place):
        return F.concat(F.substring(letters, 1, place), F.substring(letters, place + 2, 999))

    one = without(name, 1)
    two = F.when(F.col("c_custkey") % 3 == 0, without(one, 3)).when(
        F.col("c_custkey") % 3 == 1, F.overlay(one, F.lit("x"), F.lit(4))
    ).otherwise(F.concat(F.substring(one, 1, 5), F.lit("x"), F.substring(one, 6, 999)))
    three = F.overlay(two, F.lit("z"), F.lit(2))
    forms = [F.struct(form.alias("dirty"), F.lit(n).alias("n")) for form, n in ((name, 90), (one, 30), (two, 9), (three, 2))]
    customers = star.table(spark, folder, "customer")
    return customers.select(F.inline(F.array(*forms))).groupBy("dirty").agg(F.sum("n").alias("n"))


@query
def two_edit_names(spark, folder):
    """What is within two edits of a far more frequent name joins it; three edits are too many."""
    counts = _mistyped_names(spark, folder).where(F.col("n") != 30)
    return names.canonical_names(counts, distance=2)


@query
def chained_names(spark, folder):
    """Each form is one edit from the one before; followed from one to the next, all lead to the name."""
    return names.canonical_names(_mistyped_names(spark, folder), chains=True)


@query
def unchained_names(spark, folder):
    """The same forms with one edit allowed: the third and fourth form stay apart."""
    return names.canonical_names(_mistyped_names(spark, folder))


@query
def vocabulary_match(spark, folder):
    """Texts about suppliers against the table of suppliers: the first entry that holds the text, or is held by it."""
    suppliers = star.table(spark, folder, "supplier")
    entries = suppliers.select((F.col("s_suppkey") * 7919 % 100003).alias("ordinal"), F.col("s_name").alias("entry"))
    part = F.col("l_partkey")
    number = F.lpad(F.floor(part / 16).cast("string"), 9, "0")
    text = (
        F.when(part % 4 == 0, F.concat(F.lit("via SUPPLIER#"), number, F.lit(" today")))
        .when(part % 4 == 1, F.concat(F.lit("plier#"), number))
        .when(part % 4 == 2, F.right(number, F.lit(4)))
        .otherwise(F.concat(F.lit("depot "), part.cast("string")))
    )
    values = star.table(spark, folder, "lineitem").select(text.alias("dirty"))
    return containment.first_containing(values, entries)


@query
def resolve_batches(spark, folder):
    values = mapping.distinct_values(star.dirty_texts(spark, folder), "customer_name")

    def answer(batch):  # stands in for an external service; it only knows names of even length
        return {name: name.strip().upper() for name in batch if len(name) % 2 == 0}

    return resolver.resolve_batches(values, answer)


@query
def resolver_calls(spark, folder):
    """The calls that an external resolver would get for all spellings of customers: 50 values each, in order."""
    values = mapping.distinct_values(star.dirty_texts(spark, folder), "customer_name")
    return resolver.batch_sizes(resolver.batches_of(values))


@query
def restarted_resolver(spark, folder):
    """Two runs into one stored mapping: in the first some calls fail, the second asks for the values without an answer."""
    path = fresh_path(spark, "mapping")
    values = stage(mapping.distinct_values(star.dirty_texts(spark, folder), "customer_name"), "values")

    def failing(batch):
        if len(batch[0]) % 3 == 0:
            raise TimeoutError("the service is down")
        return {value: f"first {value}" for value in batch}

    with contextlib.suppress(ResolverError):
        resolve_into(values, path, "customers", failing)
    resolve_into(values, path, "customers", lambda batch: {value: f"second {value}" for value in batch})
    return read_mapping(spark, path, "customers")


def _answers(spark, folder):
    """One JSON answer per customer; every seventh is cut short, every eleventh is empty."""
    customers = star.table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    dirty = F.concat(F.lower("c_name"), F.lit(" / "), F.lower("c_mktsegment"))
    full = F.to_json(F.struct(F.create_map(F.col("dirty"), F.col("c_name")).alias("mapping")))
    answer = (
        F.when(F.col("c_custkey") % 7 == 0, F.left(full, F.lit(15)))
        .when(F.col("c_custkey") % 11 == 0, F.lit("{}"))
        .otherwise(full)
    )
    return customers.withColumn("dirty", dirty).withColumn("answer", answer)


@query
def parse_mapping_json(spark, folder):
    return resolver.answers_for(_answers(spark, folder), "dirty", "answer")


@query
def mapping_rows(spark, folder):
    return resolver.mapping_rows(_answers(spark, folder), "answer")


# --- the cleaning job -------------------------------------------------------


@query
def clean_transactions(spark, folder):
    # the names need no more than line items and orders
    names_found = cleaning.name_mapping(star.dirty_texts(spark, folder))
    return cleaning.clean_transactions(star.dirty_transactions(spark, folder), names_found)


@query
def clean_with_resolver(spark, folder):
    """The cleaning job with a resolver for regions and segments that answers some values outside the vocabulary."""

    def answer(batch):
        known = {"NE": "Northeast", "Global": "International", "W": "The West", "Timber": "Wood Products", "chem": "Chemistry"}
        return {value: known[value] for value in batch if value in known}

    paths = [fresh_path(spark, name) for name in ("clean", "report", "mapping")]
    texts = star.dirty_texts(spark, folder)
    raw = texts.select(*[F.col(c) if c in texts.columns else F.lit(None).cast("string").alias(c) for c in RAW_COLUMNS])
    run_cleaning(raw, *paths, resolvers={"regions": answer, "segments": answer})
    columns = ["transaction_id", "region", "region_clean", "industry_segment", "industry_segment_clean"]
    return files.read_clean(spark, paths[0]).select(columns)


@query
def cleaning_profile(spark, folder):
    return profile.cleaning_profile(star.dirty_texts(spark, folder))


@query
def cleaning_report(spark, folder):
    return profile.cleaning_report(cleaning_profile(spark, folder))


@query
def analyzable_rows(spark, folder):
    rows = measures.analyzable(cleaning.clean_values(star.dirty_texts(spark, folder)))
    return rows.select("transaction_id", "region_clean", "order_date_clean", "revenue_usd_clean")


@query
def exclusion_counts(spark, folder):
    return measures.exclusion_counts(cleaning.clean_values(star.dirty_texts(spark, folder)))


@query
def load_clean_rows(spark, folder):
    path = fresh_path(spark, "clean")
    cleaning.clean_transactions(star.dirty_texts(spark, folder)).write.parquet(path)
    columns = ["transaction_id", "customer_name_clean", "industry_segment_clean", "revenue_usd_clean"]
    return load_clean(spark, path).select(columns)


@query
def cleaned_pareto(spark, folder):
    """Raw texts to Pareto: revenue is added up per spelling before the names are looked up."""
    rows = measures.analyzable(cleaning.clean_values(star.dirty_texts(spark, folder)))
    line = measures.measures_of(F.col("transaction_id"), F.col("revenue_usd_clean"), F.col("order_date_clean"))
    per_spelling = stage(
        measures.roll_up(
            rows.select("customer_name", *[column.alias(name) for name, column in line.items()]), "customer_name"
        ),
        "spellings",
    )
    counts = per_spelling.select(F.col("customer_name").alias("dirty"), F.col("row_count").alias("n"))
    names_found = stage(names.canonical_names(counts), "names")
    mapped = mapping.apply_mapping(
        per_spelling, "customer_name", names_found, measures.CUSTOMER, "customer_name", counts=counts
    )
    return pareto.customer_pareto(mapped)


@query
def odd_amounts(spark, folder):
    """Amounts that are very large, infinite or no number at all: nothing stops, and every row is accounted for."""
    kind = F.col("l_orderkey") % 50
    amount = (
        F.when(kind == 0, 1e20)
        .when(kind == 1, F.lit(float("nan")))
        .when(kind == 2, F.lit(float("inf")))
        .when(kind == 3, F.lit(float("-inf")))
        .when(kind == 4, numeric.parse_money(F.lit("5e400")))
        .when(kind == 5, -F.col("l_extendedprice"))
        .otherwise(F.col("l_extendedprice"))
    )
    lines = star.table(spark, folder, "lineitem").select(
        star.transaction_id().alias("transaction_id"),
        F.col("l_returnflag").alias(measures.CUSTOMER),
        F.lit(None).cast("string").alias(measures.REGION),
        F.col("l_linestatus").alias(measures.SEGMENT),
        F.col("l_shipdate").cast("date").alias(measures.DAY),
        amount.alias("revenue_usd_clean"),
    )
    counts = measures.exclusion_counts(lines)
    kept = summary.dataset_summary(measures.to_measures(measures.analyzable(lines)))
    return counts.withColumn("total_revenue", kept.select("total_revenue").scalar())


# --- quality checks ------------------------------------------------------------


@query
def dq_checks(spark, folder):
    # the sender's count: one row for each line of an order
    expected = star.table(spark, folder, "lineitem").agg(F.count(F.lit(1))).scalar()
    return quality.quality_checks(star.dirty_texts(spark, folder), expected, RAW_OF_TEXTS)


@query
def dq_required_columns(spark, folder):
    return quality.column_check(star.dirty_transactions(spark, folder))


# --- files, publication, delivery -------------------------------------------


@query
def scan_raw_csv(spark, folder):
    path = fresh_path(spark, "raw-csv")
    files.write_csv(star.dirty_transactions(spark, folder), path)
    return files.read_raw_csv(spark, path)


@query
def scan_csv_reordered(spark, folder):
    """Columns in another order, and one that nobody asked for: bound by their names."""
    path = fresh_path(spark, "raw-csv")
    raw = star.dirty_transactions(spark, folder)
    files.write_csv(raw.select(*reversed(raw.columns), F.lit("x").alias("more")), path)
    return files.read_raw_csv(spark, path)


@query
def scan_csv_missing_column(spark, folder):
    """What the scan says about a file without two of the columns."""
    path = fresh_path(spark, "raw-csv")
    files.write_csv(star.dirty_texts(spark, folder), path)
    header = spark.read.option("header", True).csv(path)
    return quality.column_check(header).select("column_name", "present", "filled_rows")


def _damaged_csv(spark, folder):
    """Raw transactions as CSV lines of which some lack fields, have too many, or are cut in two within a quoted value."""
    raw = star.dirty_transactions(spark, folder)
    path = fresh_path(spark, "raw-csv")
    number = F.try_element_at(F.split("transaction_id", "-"), F.lit(1)).cast("long") % 11
    values = [F.concat(F.lit('"'), F.coalesce(F.col(c), F.lit("")), F.lit('"')) for c in RAW_COLUMNS]
    cut = F.lit('"cut\nin two"')
    line = (
        F.when(number == 0, F.concat_ws(",", *values[:-2]))
        .when(number == 1, F.concat_ws(",", *values, F.lit("more")))
        .when(number == 2, F.concat_ws(",", *values[:-1], cut))
        .when(number == 3, F.concat_ws(",", values[0], cut, *values[2:]))
        .otherwise(F.concat_ws(",", *values))
    )
    # written as they are, under a column whose name is the header, so that every file begins with it
    as_they_are = {"sep": "\u0001", "quote": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    lines = raw.select(F.explode(F.split(line, "\n")).alias(",".join(RAW_COLUMNS)))
    # compressed, the lines take a fifth of the disk; each file, as large as a task's share, is then read by one task
    lines.write.options(header=True, compression="gzip", **as_they_are).csv(path)
    return path


@query
def scan_damaged_csv(spark, folder):
    return files.scan_raw_records(spark, _damaged_csv(spark, folder), tolerated=0.6).rows


@query
def rejected_records(spark, folder):
    scan = files.scan_raw_records(spark, _damaged_csv(spark, folder), tolerated=0.6)
    return scan.rejected.select("record", "problem")


@query
def clean_damaged_csv(spark, folder):
    """What the report of the cleaning job says about a file with damaged records."""
    paths = [fresh_path(spark, name) for name in ("clean", "report")]
    report = run_cleaning_file(spark, _damaged_csv(spark, folder), *paths, tolerated=0.6)
    return report.select("rows_processed", "records_rejected", "after.null_revenues", "before.unique_regions")


@query
def scan_errors(spark, folder):
    """What the scans say about input that is not there yet, or lacks columns, and how many rows they find otherwise."""
    path = fresh_path(spark, "raw-csv")

    def outcome(step):
        try:
            return spark.createDataFrame([(step, "read")], "step string, outcome string").withColumn(
                "rows", F.lit(files.read_raw_csv(spark, path).count())
            )
        except (FileNotFoundError, ValueError) as error:
            said = str(error).replace(path, "<path>")
            return spark.createDataFrame([(step, said)], "step string, outcome string").withColumn(
                "rows", F.lit(None).cast("long")
            )

    found = outcome("nothing written")
    raw = star.dirty_texts(spark, folder)
    files.write_csv(raw, path)
    found = found.unionByName(outcome("columns missing"))
    lacking = [F.lit(None).cast("string").alias(c) for c in RAW_COLUMNS if c not in raw.columns]
    files.write_csv(raw.select("*", *lacking), path)
    return found.unionByName(outcome("all there"))


@query
def scan_weekly_csv(spark, folder):
    path = fresh_path(spark, "weekly-csv")
    files.write_csv(weekly_revenue(spark, folder), path)
    return files.read_weekly_csv(spark, path)


@query
def scan_results_json(spark, folder):
    path = fresh_path(spark, "results")
    orders = stage(star.order_measures(spark, folder), "orders")
    result = analysis.analyze(star.with_customers(spark, folder, orders), orders)
    files.write_results(analysis.result_document(result), path)
    document = files.read_results(spark, path)
    return document.select(
        "dataset_summary.total_revenue",
        "weekly_summary.weeks_covered",
        F.size("segment_breakdown").cast("long").alias("segments"),
        F.inline("top_customers"),
    )


@query
def scan_delivery_log(spark, folder):
    """A log with one record per order day; the line of every fifth day of a month is damaged."""
    path = fresh_path(spark, "deliveries")
    days = star.table(spark, folder, "orders").select(star.order_day().alias("day")).distinct()
    report = F.concat(F.lit("weekly_report_"), F.col("day").cast("string"))
    record = F.struct(
        report.alias("report_path"),
        F.struct(
            report.alias("organized_path"), F.lit("latest").alias("latest_path"), F.lit("index").alias("index_path")
        ).alias("local"),
        F.struct(F.lit("skipped").alias("status"), F.lit("not configured").alias("reason")).alias("upload"),
        F.col("day").cast("timestamp").alias("delivered_at"),
    )
    line = F.to_json(record)
    damaged = F.dayofmonth("day") % 5 == 0
    days.select(F.when(damaged, F.left(line, F.lit(20))).otherwise(line).alias("value")).write.text(path)
    return files.read_delivery_log(spark, path).select(
        "report_path",
        F.col("upload.status").alias("upload_status"),
        F.date_format("delivered_at", "yyyy-MM-dd").alias("delivered_on"),
        "corrupt_record",
    )


def _published_weeks(spark, folder):
    """The weekly table published once per year, under the last week of that year."""
    path = fresh_path(spark, "reports")
    weeks = _staged_weeks(spark, folder)
    year = F.year(measures.DAY)
    last = weeks.groupBy(year.alias("in_year")).agg(F.max(measures.DAY).alias("last_week"))
    dated = weeks.join(last, year == F.col("in_year")).drop("in_year")
    publication.publish(dated.select(*weeks.columns, F.col("last_week")), path, "weekly", F.col("last_week"))
    return path


def _listed_reports(spark, folder):
    """The weekly table published as text once per year, in lines of one width, so that sizes are known."""
    path = fresh_path(spark, "reports")
    weeks = _staged_weeks(spark, folder)
    line = F.rpad(F.concat_ws(" ", F.col(measures.DAY).cast("string"), F.col("transactions").cast("string")), 39, " ")
    year_end = F.make_date(F.year(measures.DAY), F.lit(12), F.lit(31))
    publication.publish(weeks.withColumn("value", line), path, "weekly_report", year_end, "text", ["value"])
    return publication.report_files(spark, path)


@query
def report_catalog(spark, folder):
    return publication.report_catalog(_listed_reports(spark, folder))


@query
def report_years(spark, folder):
    return publication.catalog_by_year(_listed_reports(spark, folder))


def _delivered(spark, folder):
    """Analysis, report and delivery, one job after the other; returns the folder of the reports and the log."""
    results, reports, log = (fresh_path(spark, name) for name in ("results", "reports", "log"))
    orders = stage(star.order_measures(spark, folder), "orders")
    analysis.run_analysis(star.with_customers(spark, folder, orders), orders, results)
    reporting.deliver(spark, f"{results}/analysis_results", f"{results}/weekly_revenue", reports, log)
    return reports, log


@query
def delivered_report(spark, folder):
    reports, _ = _delivered(spark, folder)
    return publication.latest(spark, f"{reports}/customers").select(
        "rank", measures.CUSTOMER, "revenue", "share", "report_date"
    )


@query
def published_tables(spark, folder):
    """All eight tables of a delivered report, as they were published, in one form."""
    reports, _ = _delivered(spark, folder)
    columns = {
        "kpi_tiles": {"label": "label", "text": "value"},
        "takeaway": {"text": "takeaway"},
        "customers": {
            "label": measures.CUSTOMER, "amount": "revenue", "count": "transactions", "share": "share",
            "more": "cumulative_share",
        },
        "segments": {
            "label": measures.SEGMENT, "amount": "revenue", "count": "transactions", "share": "share",
            "more": "unique_customers",
        },
        "regions": {
            "label": measures.REGION, "amount": "revenue", "count": "transactions", "share": "share",
            "more": "unique_customers",
        },
        "weekly": {"day": "week_ending", "amount": "revenue", "count": "transactions", "share": "wow_change", "text": "note"},
        "weekly_chart": {"day": "week_ending", "amount": "revenue"},
        "pareto_curve": {"label": measures.CUSTOMER, "share": "cumulative_share", "more": "threshold_line"},
    }
    kinds = {"label": "string", "day": "date", "amount": "double", "count": "long", "share": "double", "more": "double", "text": "string"}
    tables = []
    for name, own in columns.items():
        published = publication.latest(spark, f"{reports}/{name}")
        values = [
            (F.col(own[column]) if column in own else F.lit(None)).cast(kind).alias(column) for column, kind in kinds.items()
        ]
        tables.append(published.select(F.lit(name).alias("report_table"), *values, "report_date"))
    return functools.reduce(DataFrame.unionByName, tables)


@query
def published_segments(spark, folder):
    """A published breakdown with as many values as there are suppliers."""
    results, reports, log = (fresh_path(spark, name) for name in ("results", "reports", "log"))
    lines = star.base_transactions(spark, folder)
    measured = measures.to_measures(
        lines.select(
            "transaction_id",
            F.col("company").alias(measures.CUSTOMER),
            F.col("true_region").alias(measures.REGION),
            F.concat(F.lit("Segment "), F.col("l_suppkey").cast("string")).alias(measures.SEGMENT),
            F.col("order_day").alias(measures.DAY),
            F.col("l_extendedprice").alias("revenue_usd_clean"),
        )
    )
    # days and all else are added up in one pass, for which line items meet the orders once
    analysis.run_analysis(measured, None, results)
    reporting.deliver(spark, f"{results}/analysis_results", f"{results}/weekly_revenue", reports, log)
    return publication.latest(spark, f"{reports}/segments").drop("year")


@query
def delivery_entries(spark, folder):
    _, log = _delivered(spark, folder)
    return files.read_delivery_log(spark, log).select(
        "report_path",
        dates.date_in_name(F.col("report_path")).alias("report_date"),
        dates.report_year(F.col("report_path")).alias("year"),
        F.col("upload.status").alias("upload_status"),
    )


@query
def latest_report(spark, folder):
    path = _published_weeks(spark, folder)
    return publication.latest(spark, f"{path}/weekly").select(
        measures.DAY, "revenue", "transactions", "report_date"
    )


@query
def triage_errors(spark, folder):
    kind = F.col("event_id") % 5
    message = F.concat(
        F.when(kind == 0, F.lit("login refused (401) for user "))
        .when(kind == 1, F.lit("upload not allowed (403) for user "))
        .when(kind == 2, F.lit("no such address (404) asked for by user "))
        .when(kind == 3, F.lit("the host lookup failed to resolve for user "))
        .otherwise(F.lit("the line broke off while serving user ")),
        F.col("user_id").cast("string"),
        F.lit(" "),
        F.repeat(F.col("props"), 30),
    )
    events = star.table(spark, folder, "events").select("event_id", message.alias("message"))
    return triage.triage(events, "message").select("event_id", "cause", "hint", "reason")
