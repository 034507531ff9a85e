"""SQL twins of the registered queries, for an independent engine on the same tables.

The twins of the cleaning queries know the true region, segment, day and amount of
every row, so they state the right answer instead of repeating the cleaning. Names
are clustered anew, by comparing all spellings of a customer number with each other.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

# The vocabularies and spellings, stated here once more, so that a slip in the library's own shows.
REGIONS = {
    "Northeast": ["Northeast", "NE", "North East", "north-east", "N.E.", "Northeastern"],
    "Southeast": ["Southeast", "SE", "South East", "south east", "S.E.", "Southeastern"],
    "Midwest": ["Midwest", "MW", "Mid-West", "midwest", "Mid West", "Middle West"],
    "Southwest": ["Southwest", "SW", "South West", "south-west", "S.W."],
    "West": ["West", "W", "West Coast", "western", "Pacific"],
    "International": ["International", "INTL", "Intl.", "Global", "Overseas", "intl"],
}

SEGMENTS = {
    "Pulp & Paper": ["Pulp & Paper", "Pulp and Paper", "Paper", "P&P", "pulp/paper", "Paper Products"],
    "Mining": ["Mining", "Mining & Extraction", "mining", "MINING", "Minerals"],
    "Recycling": ["Recycling", "Recycle", "recycling", "Recyc.", "Waste Management"],
    "Chemical Processing": ["Chemical Processing", "Chemicals", "Chemical", "Chem Proc", "chem"],
    "Food & Beverage": ["Food & Beverage", "F&B", "Food/Bev", "Food and Beverage", "food & bev"],
    "Wood Products": ["Wood Products", "Wood", "Timber", "Lumber", "wood prod"],
}

# What triage says to a message that holds one of the words, tried in this order.
CAUSES = [
    ("authentication", ["unauthorized", "401"], "Authentication failed: check the client id and secret."),
    ("permission", ["forbidden", "403"], "Signed in, but the permission to write is missing."),
    ("site", ["not found", "404"], "The site or document library does not exist: check the address."),
    ("network", ["name resolution", "failed to resolve"], "Network or DNS issue: is the address reachable?"),
]
OTHER = ("other", "See the message and check the delivery settings.")

ORACLES: dict[str, str] = {}


def _text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _list(values: Sequence[str | None]) -> str:
    return "[" + ", ".join(_text(value) for value in values) + "]"


def _round(value: str, digits: int = 2) -> str:
    scale = 10**digits
    return f"round_even(({value}) * {scale}.0::DOUBLE, 0) / {scale}.0::DOUBLE"


def _pct(part: str, whole: str) -> str:
    return _round(f"{part} / nullif({whole}, 0) * 100.0::DOUBLE")


# --- revenue analytics ---------------------------------------------------------

_TX = """
tx AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS transaction_id,
         c_name AS customer_name_clean, r_name AS region_clean, c_mktsegment AS industry_segment_clean,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, CAST(o_orderdate AS DATE) AS day
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
)"""

_PARETO_OVER_TX = f"""
agg AS (
  SELECT customer_name_clean, sum(amount) AS exact, CAST(sum(amount) AS DOUBLE) AS revenue,
         count(transaction_id) AS transactions, count(amount) AS priced
  FROM tx WHERE customer_name_clean IS NOT NULL GROUP BY 1
),
ordered AS (
  SELECT *, row_number() OVER (ORDER BY exact DESC, customer_name_clean) AS rank,
         sum(exact) OVER (ORDER BY exact DESC, customer_name_clean ROWS UNBOUNDED PRECEDING) AS running,
         sum(exact) OVER () AS total
  FROM agg
),
pareto AS (
  SELECT customer_name_clean,
         {_round('revenue')} AS revenue,
         CAST(transactions AS BIGINT) AS transactions,
         {_round('revenue / priced')} AS avg_order_value,
         CAST(rank AS BIGINT) AS rank,
         {_pct('revenue', 'CAST(total AS DOUBLE)')} AS pct_of_total,
         {_pct('CAST(running AS DOUBLE)', 'CAST(total AS DOUBLE)')} AS cumulative_pct,
         rank <= coalesce((SELECT min(rank) FROM ordered WHERE running >= 0.80 * total), 9223372036854775807)
           AS is_pareto_80
  FROM ordered
)"""

_PARETO = f"{_TX}, {_PARETO_OVER_TX}"

_PARETO_SUMMARY = f"""
pareto_summary AS (
  SELECT CAST(count(*) AS BIGINT) AS total_customers,
         CAST(count(*) FILTER (is_pareto_80) AS BIGINT) AS pareto_customers,
         {_round('CAST(100 * count(*) FILTER (is_pareto_80) AS DOUBLE) / count(*)', 1)} AS pareto_customer_pct,
         {_round('CAST(sum(CAST(pct_of_total AS DECIMAL(18,2))) FILTER (is_pareto_80) AS DOUBLE)', 1)}
           AS pareto_revenue_pct,
         arg_min(customer_name_clean, rank) AS top_1_customer,
         arg_min(pct_of_total, rank) AS top_1_revenue_pct
  FROM pareto
)"""


def _breakdown(dimension: str) -> str:
    return f"""
{dimension}_rows AS (
  SELECT {dimension}, {_round('CAST(sum(amount) AS DOUBLE)')} AS revenue,
         CAST(count(transaction_id) AS BIGINT) AS transactions,
         CAST(count(DISTINCT customer_name_clean) AS BIGINT) AS unique_customers,
         {_pct('CAST(sum(amount) AS DOUBLE)', '(SELECT CAST(sum(amount) AS DOUBLE) FROM tx)')} AS pct_of_total
  FROM tx WHERE {dimension} IS NOT NULL GROUP BY 1
)"""


_WEEKLY = f"""
by_week AS (
  SELECT CAST(date_trunc('week', day) + INTERVAL 6 DAY AS DATE) AS week, sum(amount) AS exact, count(amount) AS n
  FROM tx WHERE day IS NOT NULL GROUP BY 1
),
spine AS (
  SELECT CAST(unnest(generate_series(min(week), max(week), INTERVAL 7 DAY)) AS DATE) AS week FROM by_week
),
filled AS (
  SELECT spine.week AS order_date_clean,
         {_round('coalesce(CAST(exact AS DOUBLE), 0.0::DOUBLE)')} AS revenue,
         CAST(coalesce(n, 0) AS BIGINT) AS transactions
  FROM spine LEFT JOIN by_week USING (week)
),
weekly AS (
  SELECT *, {_round('(revenue / nullif(lag(revenue) OVER (ORDER BY order_date_clean), 0) - 1) * 100.0::DOUBLE')}
    AS wow_change_pct
  FROM filled
)"""

_WEEKLY_SUMMARY = f"""
weekly_summary AS (
  SELECT CAST(count(*) AS BIGINT) AS weeks_covered,
         {_round('CAST(sum(CAST(revenue AS DECIMAL(28,2))) AS DOUBLE) / count(*)')} AS avg_weekly_revenue,
         max(revenue) AS best_week_revenue, min(revenue) AS worst_week_revenue,
         (SELECT revenue FROM weekly ORDER BY order_date_clean DESC LIMIT 1) AS latest_week_revenue,
         (SELECT wow_change_pct FROM weekly ORDER BY order_date_clean DESC LIMIT 1) AS latest_wow_change
  FROM weekly
)"""

_DATASET = f"""
dataset_summary AS (
  SELECT {_round('CAST(sum(amount) AS DOUBLE)')} AS total_revenue,
         CAST(count(*) AS BIGINT) AS total_transactions,
         strftime(min(day), '%Y-%m-%d') AS date_range_start,
         strftime(max(day), '%Y-%m-%d') AS date_range_end,
         CAST(count(DISTINCT customer_name_clean) AS BIGINT) AS unique_customers,
         CAST(count(DISTINCT industry_segment_clean) AS BIGINT) AS unique_segments,
         CAST(count(DISTINCT region_clean) AS BIGINT) AS unique_regions
  FROM tx
)"""

_MARKED = """
marked AS (
  SELECT *, transactions < (SELECT median(transactions) FROM weekly) * 0.4::DOUBLE AS is_partial FROM weekly
)"""

# a line of 39 characters and its end for each week of a year
_REPORTS = """
reports AS (
  SELECT CAST(year(order_date_clean) AS INTEGER) AS year, make_date(year(order_date_clean), 12, 31) AS report_date,
         CAST(40 * count(*) AS BIGINT) AS bytes FROM weekly GROUP BY ALL
)"""

_SEGMENT, _REGION = "industry_segment_clean", "region_clean"
_TOP = "SELECT * FROM pareto WHERE rank <= 20"

ORACLES.update(
    customer_pareto=f"WITH {_PARETO} SELECT * FROM pareto",
    customer_revenue=f"WITH {_PARETO} SELECT customer_name_clean, revenue, transactions, avg_order_value FROM pareto",
    vip_customers=f"WITH {_PARETO} SELECT * FROM pareto WHERE is_pareto_80",
    top_customers=f"WITH {_PARETO} {_TOP}",
    pareto_summary=f"WITH {_PARETO}, {_PARETO_SUMMARY} SELECT * FROM pareto_summary",
    segment_breakdown=f"WITH {_TX}, {_breakdown(_SEGMENT)} SELECT * FROM {_SEGMENT}_rows",
    region_breakdown=f"WITH {_TX}, {_breakdown(_REGION)} SELECT * FROM {_REGION}_rows",
    top_segments=f"""WITH {_TX}, {_breakdown(_SEGMENT)}
SELECT * FROM {_SEGMENT}_rows ORDER BY revenue DESC, {_SEGMENT} LIMIT 5""",
    top_regions=f"""WITH {_TX}, {_breakdown(_REGION)}
SELECT * FROM {_REGION}_rows ORDER BY revenue DESC, {_REGION} LIMIT 5""",
    weekly_revenue=f"WITH {_TX}, {_WEEKLY} SELECT * FROM weekly",
    weekly_summary=f"WITH {_TX}, {_WEEKLY}, {_WEEKLY_SUMMARY} SELECT * FROM weekly_summary",
    weekly_trend=f"""WITH {_TX}, {_WEEKLY}, {_WEEKLY_SUMMARY}
SELECT latest_wow_change, CASE WHEN latest_wow_change > 0 THEN '▲' WHEN latest_wow_change IS NOT NULL THEN '▼' END
  AS arrow, abs(latest_wow_change) AS size_pct FROM weekly_summary""",
    dataset_summary=f"WITH {_TX}, {_DATASET} SELECT * FROM dataset_summary",
    kpi_tiles=f"""WITH {_PARETO}, {_PARETO_SUMMARY}, {_WEEKLY}, {_WEEKLY_SUMMARY}, {_DATASET},
facts AS (SELECT * FROM dataset_summary, pareto_summary, weekly_summary)
SELECT 1 AS position, 'TOTAL REVENUE' AS label,
       '$' || format('{{:,}}', CAST(round_even(total_revenue, 0) AS BIGINT)) AS value FROM facts
UNION ALL SELECT 2, 'TRANSACTIONS', format('{{:,}}', total_transactions) FROM facts
UNION ALL SELECT 3, 'UNIQUE CUSTOMERS', CAST(unique_customers AS VARCHAR) FROM facts
UNION ALL SELECT 4, '80/20 TIER SIZE', pareto_customers || ' customers' FROM facts
UNION ALL SELECT 5, 'REVENUE CONCENTRATION', pareto_revenue_pct || '% of revenue' FROM facts
UNION ALL SELECT 6, 'AVG WEEKLY REVENUE',
       '$' || format('{{:,}}', CAST(round_even(avg_weekly_revenue, 0) AS BIGINT)) FROM facts""",
    takeaway=f"""WITH {_PARETO}, {_PARETO_SUMMARY}
SELECT pareto_customers || ' customer(s), ' || pareto_customer_pct || ' % of them all, bring ' || pareto_revenue_pct
  || ' % of the revenue; ' || top_1_customer || ' alone brings ' || printf('%.1f', top_1_revenue_pct)
  || ' % and is the account to look after first.' AS takeaway FROM pareto_summary""",
    report_customers=f"""WITH {_PARETO}
SELECT rank, customer_name_clean, revenue, transactions, avg_order_value, pct_of_total / 100 AS share,
       cumulative_pct / 100 AS cumulative_share, is_pareto_80 AS is_vip FROM ({_TOP})""",
    report_segments=f"""WITH {_TX}, {_breakdown(_SEGMENT)}
SELECT {_SEGMENT}, revenue, transactions, unique_customers, pct_of_total / 100 AS share FROM {_SEGMENT}_rows""",
    report_regions=f"""WITH {_TX}, {_breakdown(_REGION)}
SELECT {_REGION}, revenue, transactions, unique_customers, pct_of_total / 100 AS share FROM {_REGION}_rows""",
    weekly_report=f"""WITH {_TX}, {_WEEKLY}, {_MARKED}
SELECT order_date_clean AS week_ending, revenue, transactions,
       CASE WHEN NOT is_partial THEN wow_change_pct / 100 END AS wow_change, is_partial,
       CASE WHEN is_partial THEN 'Incomplete week' ELSE '' END AS note FROM marked""",
    weekly_complete=f"""WITH {_TX}, {_WEEKLY}, {_MARKED}
SELECT order_date_clean AS week_ending, revenue FROM marked WHERE NOT is_partial""",
    pareto_curve=f"""WITH {_PARETO}
SELECT rank, customer_name_clean, cumulative_pct / 100 AS cumulative_share, 0.8::DOUBLE AS threshold_line
FROM ({_TOP})""",
    scan_weekly_csv=f"WITH {_TX}, {_WEEKLY} SELECT * FROM weekly",
    scan_results_json=f"""WITH {_PARETO}, {_WEEKLY}, {_WEEKLY_SUMMARY}, {_DATASET}
SELECT total_revenue, weeks_covered, unique_segments AS segments, p.*
FROM dataset_summary, weekly_summary, ({_TOP}) p""",
    report_catalog=f"""WITH {_TX}, {_WEEKLY}, {_REPORTS}
SELECT year, report_date, 'weekly_report_' || report_date AS name, bytes, printf('%.1f', bytes / 1024) || ' KB' AS size
FROM reports""",
    report_years=f"""WITH {_TX}, {_WEEKLY}, {_REPORTS}
SELECT year, CAST(count(*) AS BIGINT) AS reports, CAST(sum(bytes) AS BIGINT) AS bytes, max(report_date) AS latest_report
FROM reports GROUP BY GROUPING SETS ((year), ())""",
    delivered_report=f"""WITH {_PARETO}
SELECT rank, customer_name_clean, revenue, pct_of_total / 100 AS share, (SELECT max(day) FROM tx) AS report_date
FROM ({_TOP})""",
    delivery_entries=f"""WITH {_TX}
SELECT 'weekly_report_' || max(day) AS report_path, CAST(max(day) AS VARCHAR) AS report_date,
       CAST(year(max(day)) AS INTEGER) AS year, 'skipped' AS upload_status FROM tx""",
    latest_report=f"""WITH {_TX}, {_WEEKLY}
SELECT order_date_clean, revenue, transactions, (SELECT max(order_date_clean) FROM weekly) AS report_date
FROM weekly WHERE year(order_date_clean) = (SELECT max(year(order_date_clean)) FROM weekly)""",
)


# --- texts in need of cleaning, and what cleaning makes of them -----------------


def _weighted(bound: int, *weights: int) -> str:
    keys = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return "((" + " + ".join(f"{key} * {weight}" for key, weight in zip(keys, weights)) + f") % {bound})"


def _spelling(entry: str, spellings: Mapping[str, Sequence[str]], pick: str) -> str:
    branches = " ".join(
        f"WHEN {_text(name)} THEN {_list(variants)}[CAST({pick} % {len(variants)} + 1 AS INTEGER)]"
        for name, variants in spellings.items()
    )
    return f"CASE {entry} {branches} END"


_BASE = f"""
base AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS transaction_id,
         l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, o_orderpriority,
         CAST(o_orderdate AS DATE) AS order_day, c_name AS company,
         {_list(list(REGIONS))}[CAST(o_custkey % 6 + 1 AS INTEGER)] AS true_region,
         {_list(list(SEGMENTS))}[CAST(l_partkey % 6 + 1 AS INTEGER)] AS true_segment
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
),
picked AS (
  SELECT *, {_weighted(100, 31, 17, 7, 13)} AS name_variant, {_weighted(7, 2, 3, 5, 1)} + 2 AS lost,
         {_weighted(6, 1, 5, 3, 4)} AS date_variant, {_weighted(1000, 13, 57, 19, 23)} AS revenue_variant
  FROM base
),
dirty AS (
  SELECT *,
         CASE WHEN name_variant < 70 THEN company WHEN name_variant < 80 THEN upper(company)
              WHEN name_variant < 88 THEN lower(company)
              WHEN name_variant < 93 THEN '  ' || replace(company, '#', '  #') || chr(9)
              WHEN name_variant < 97 THEN replace(company, '#', ' - ')
              ELSE left(company, CAST(lost AS INTEGER) - 1) || substr(company, CAST(lost AS INTEGER) + 1)
         END AS customer_name,
         {_spelling('true_region', REGIONS, _weighted(30, 7, 1, 13, 11))} AS region,
         {_spelling('true_segment', SEGMENTS, f"({_weighted(180, 11, 3, 1, 7)} // 6)")} AS industry_segment,
         CASE date_variant
           WHEN 0 THEN strftime(order_day, '%Y-%m-%d') WHEN 1 THEN strftime(order_day, '%m/%d/%Y')
           WHEN 2 THEN strftime(order_day, '%d/%m/%Y') WHEN 3 THEN strftime(order_day, '%d.%m.%Y')
           WHEN 4 THEN strftime(order_day, '%-d-%b-%Y') WHEN 5 THEN strftime(order_day, '%B %-d, %Y')
         END AS order_date,
         CASE WHEN revenue_variant < 6
              THEN ['1e20', '5e400', 'NaN', 'Infinity', '-Infinity', 'unknown'][CAST(revenue_variant + 1 AS INTEGER)]
              WHEN revenue_variant < 40 THEN NULL
              WHEN revenue_variant < 55 THEN '-' || CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)
              WHEN revenue_variant < 100 THEN '$ ' || format('{{:,.2f}}', l_extendedprice)
              ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS revenue_usd,
         -- what the cleaning must come to: a day-first text that reads as month-first is taken as that
         CASE WHEN date_variant = 2 AND day(order_day) <= 12
              THEN make_date(year(order_day), day(order_day), month(order_day)) ELSE order_day END AS clean_day,
         CASE WHEN revenue_variant = 0 THEN 1e20::DOUBLE WHEN revenue_variant < 40 THEN NULL
              WHEN revenue_variant < 55 THEN -l_extendedprice ELSE l_extendedprice END AS clean_revenue,
         date_variant IN (1, 2) AND day(order_day) <= 12 AND day(order_day) <> month(order_day) AS is_ambiguous
  FROM picked
)"""

_COUNTABLE = "clean_revenue BETWEEN 0 AND 1e25"

# the same over whole cents, where amounts may have more digits than a decimal can hold with cents
_PARETO_OVER_CENTS = (
    _PARETO_OVER_TX.replace("CAST(sum(amount) AS DOUBLE)", "CAST(sum(amount) AS DOUBLE) / 100")
    .replace("CAST(total AS DOUBLE)", "(CAST(total AS DOUBLE) / 100)")
    .replace("CAST(running AS DOUBLE)", "(CAST(running AS DOUBLE) / 100)")
    .replace("running >= 0.80 * total", "5 * running >= 4 * total")
)

# Spellings of one customer number, compared pair by pair: a key joins its most frequent neighbour within one edit if
# that has three times its rows and joins none itself.
_NAMES = f"""
spelled AS (
  SELECT company, customer_name AS dirty, CAST(count(*) AS BIGINT) AS n,
         regexp_replace(lower(customer_name), '[^a-z0-9]', '', 'g') AS key,
         trim(regexp_replace(customer_name, '\\s+', ' ', 'g')) AS written, lower(trim(customer_name, ' ' || chr(9))) AS t
  FROM dirty GROUP BY company, customer_name
),
keyed AS (SELECT company, key, sum(n) AS n FROM spelled GROUP BY company, key),
wished AS (
  SELECT a.company, a.key, min(CASE WHEN b.key IS NOT NULL THEN {{'n': -b.n, 'key': b.key}} END) AS best
  FROM keyed a LEFT JOIN keyed b ON a.company = b.company AND a.key <> b.key AND levenshtein(a.key, b.key) = 1
    AND b.n >= 3 * a.n
  GROUP BY a.company, a.key
),
headed AS (
  SELECT w.company, w.key, coalesce(h.key, w.key) AS head FROM wished w
  LEFT JOIN wished h ON w.company = h.company AND w.best.key = h.key AND h.best IS NULL
),
best_written AS (
  SELECT company, key, written, row_number() OVER (PARTITION BY company, key ORDER BY n DESC, written) AS place
  FROM (SELECT company, key, written, sum(n) AS n FROM spelled GROUP BY company, key, written)
),
names AS (
  SELECT s.dirty, b.written AS clean, s.n, s.t, s.key,
         CASE WHEN h.head <> s.key THEN 'edit' WHEN s.written <> b.written THEN 'spelling' ELSE 'same' END AS merged_by
  FROM spelled s JOIN headed h ON s.company = h.company AND s.key = h.key
  JOIN best_written b ON b.company = h.company AND b.key = h.head AND b.place = 1
)"""

_RAW = f"""{_BASE},
raw AS (
  SELECT dirty.*, p_brand AS product_sku, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS quantity, s_name AS sales_rep,
         CASE WHEN {_weighted(70, 3, 7, 1, 9)} % 7 = 0 THEN '' WHEN {_weighted(70, 3, 7, 1, 9)} % 7 <> 1
              THEN o_orderpriority END AS notes
  FROM dirty LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
)"""

_RAW_COLUMNS = [
    "transaction_id", "customer_name", "region", "industry_segment", "product_sku", "order_date", "quantity",
    "revenue_usd", "sales_rep", "notes",
]
_RAW_LIST = ", ".join(_RAW_COLUMNS)

# the scan takes an empty note, and the text NaN, as missing
_MISSING_TEXTS = "nullif(notes, '') AS notes, nullif(revenue_usd, 'NaN') AS revenue_usd"

_KEY = "regexp_replace(lower(dirty), '[^a-z0-9]', '', 'g')"


def _values(pairs: Mapping[str, str], name: str) -> str:
    rows = ", ".join(f"({_text(a)}, {_text(b)})" for a, b in pairs.items())
    return f"{name}(dirty, clean) AS (VALUES {rows})"


_HALF = _values({spelling: entry for entry in list(REGIONS)[:3] for spelling in REGIONS[entry]}, "half")
_REGION_VALUES = "regions AS (SELECT region AS dirty, any_value(true_region) AS clean, count(*) AS n FROM dirty GROUP BY 1)"


def _fallback(value: str, vocabulary: Sequence[str]) -> str:
    branches = " ".join(
        f"WHEN contains(lower({value}), {_text(entry.lower())}) OR contains({_text(entry.lower())}, lower({value})) "
        f"THEN {_text(entry)}"
        for entry in vocabulary
    )
    return f"CASE {branches} ELSE {_text(list(vocabulary)[0])} END"


def _canonical(column: str, truth: str, spellings: Mapping[str, Sequence[str]]) -> str:
    keys = sorted({re.sub("[^a-z0-9]", "", v.lower()) for variants in spellings.values() for v in variants})
    return f"""WITH {_BASE},
counted AS (SELECT {column} AS dirty, any_value({truth}) AS clean, count(*) AS n FROM dirty GROUP BY 1)
SELECT dirty, clean, CASE WHEN list_contains({_list(list(spellings))}, dirty) THEN 'exact'
  WHEN list_contains({_list(keys)}, {_KEY}) THEN 'alias' ELSE 'other' END AS match_method,
  CAST(n AS BIGINT) AS n FROM counted"""


def _in_vocabulary(column: str, vocabulary: Sequence[str]) -> str:
    return f"""WITH {_BASE} SELECT {column} AS dirty, CAST(count(*) AS BIGINT) AS n,
  list_contains({_list(list(vocabulary))}, {column}) AS in_vocabulary FROM dirty GROUP BY {column}"""


def _shapes(column: str, missing: str) -> str:
    return f"""WITH {_BASE} SELECT regexp_replace(regexp_replace({column}, '[0-9]+', '9', 'g'), '[A-Za-z]+', 'a', 'g') AS shape,
  CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER ({missing}) AS BIGINT) AS without_value FROM dirty GROUP BY 1"""


_TITLE = """array_to_string(list_transform(range(1, length(t) + 1),
  lambda i: CASE WHEN i = 1 OR NOT regexp_matches(substr(t, i - 1, 1), '[a-z]')
                 THEN upper(substr(t, i, 1)) ELSE substr(t, i, 1) END), '')"""

_PROFILE = f"""WITH {_BASE}, {_NAMES},
profile AS (
  SELECT CAST(count(*) AS BIGINT) AS rows,
         CAST(count(DISTINCT customer_name) AS BIGINT) AS before_customers,
         CAST(count(DISTINCT region) AS BIGINT) AS before_regions,
         CAST(count(DISTINCT industry_segment) AS BIGINT) AS before_segments,
         CAST(count(*) - count(revenue_usd) AS BIGINT) AS before_null_revenues,
         (SELECT CAST(count(DISTINCT clean) AS BIGINT) FROM names) AS after_customers,
         CAST(count(DISTINCT true_region) AS BIGINT) AS after_regions,
         CAST(count(DISTINCT true_segment) AS BIGINT) AS after_segments,
         CAST(count(*) - count(clean_revenue) AS BIGINT) AS after_null_revenues,
         CAST(count(*) - count(clean_day) AS BIGINT) AS unparseable_dates
  FROM dirty
)"""


def _reduction(name: str) -> str:
    share = f"CAST(after_{name} AS DOUBLE) / before_{name}"
    return f"{_round(f'(1 - {share}) * 100.0::DOUBLE', 1)} AS {name}_pct"


def _label(name: str) -> str:
    return " ".join(word.capitalize() for word in name.split("_"))


_ANSWERS = {"NE": "Northeast", "Global": "International"}

ORACLES.update(
    dirty_names=f"WITH {_BASE}, {_NAMES} SELECT dirty, key AS name_key, n FROM names",
    dirty_regions=_in_vocabulary("region", REGIONS),
    dirty_segments=_in_vocabulary("industry_segment", SEGMENTS),
    dirty_dates=_shapes("order_date", "clean_day IS NULL"),
    dirty_revenue=_shapes("revenue_usd", "clean_revenue IS NULL"),
    dirty_transactions=f"""WITH {_BASE} SELECT transaction_id, NOT list_contains({_list(list(REGIONS))}, region) AS region,
  NOT list_contains({_list(list(SEGMENTS))}, industry_segment) AS industry_segment, date_variant <> 0 AS order_date,
  revenue_variant < 100 AS revenue_usd FROM dirty""",
    dirty_triples=f"""WITH {_BASE} SELECT DISTINCT customer_name AS dirty_customer, region AS dirty_region,
  industry_segment AS dirty_segment FROM dirty""",
    distinct_dirty=f"WITH {_BASE} SELECT region AS dirty, CAST(count(*) AS BIGINT) AS n FROM dirty GROUP BY 1",
    sorted_dirty=f"""WITH {_BASE} SELECT industry_segment AS dirty, CAST(count(*) AS BIGINT) AS n FROM dirty
GROUP BY 1 ORDER BY 1""",
    parse_dates=f"""WITH {_BASE} SELECT transaction_id, order_date, clean_day AS order_date_clean, is_ambiguous
FROM dirty""",
    parse_revenue=f"WITH {_BASE} SELECT transaction_id, revenue_usd, clean_revenue AS revenue_usd_clean FROM dirty",
    title_case=f"WITH {_BASE}, {_NAMES} SELECT dirty, {_TITLE} AS title, n FROM names",
    apply_mapping=f"""WITH {_BASE}, {_HALF}
SELECT transaction_id, region, coalesce(clean, region) AS region_clean FROM dirty LEFT JOIN half ON region = half.dirty""",
    unmapped_values=f"""WITH {_BASE}, {_HALF} SELECT region AS dirty, CAST(count(*) AS BIGINT) AS n FROM dirty
WHERE region NOT IN (SELECT dirty FROM half) GROUP BY 1""",
    merge_mapping=f"""WITH {_BASE}, {_HALF}, {_REGION_VALUES}
SELECT dirty, clean FROM half UNION ALL
SELECT dirty, clean FROM regions WHERE dirty NOT IN (SELECT dirty FROM half)""",
    stored_mapping=f"""WITH {_BASE}, {_HALF}, {_REGION_VALUES}
SELECT 'regions' AS domain, dirty, clean FROM half UNION ALL
SELECT 'regions', dirty, clean FROM regions WHERE dirty NOT IN (SELECT dirty FROM half)""",
    out_of_vocab=f"""WITH {_BASE} SELECT region AS dirty, CAST(count(*) AS BIGINT) AS n FROM dirty
WHERE NOT list_contains({_list(list(REGIONS))}, region) GROUP BY 1""",
    fallback_match=f"""WITH {_BASE}, {_REGION_VALUES}
SELECT dirty, {_fallback("dirty", REGIONS)} AS fallback, CAST(n AS BIGINT) AS n FROM regions""",
    canonical_regions=_canonical("region", "true_region", REGIONS),
    canonical_segments=_canonical("industry_segment", "true_segment", SEGMENTS),
    canonical_customers=f"WITH {_BASE}, {_NAMES} SELECT dirty, clean, n, merged_by FROM names",
    resolve_batches=f"""WITH {_BASE}, {_NAMES}
SELECT dirty, CASE WHEN length(dirty) % 2 = 0 THEN upper(trim(dirty, ' ' || chr(9))) ELSE {_TITLE} END AS clean FROM names""",
    parse_mapping_json=f"""WITH asked AS (
  SELECT lower(c_name) || ' / ' || lower(c_mktsegment) AS dirty, c_name, lower(c_name) || ' / ' || lower(c_mktsegment)
    AS t, c_custkey % 7 <> 0 AND c_custkey % 11 <> 0 AS answered FROM customer)
SELECT dirty, CASE WHEN answered THEN c_name ELSE {_TITLE} END AS clean, answered FROM asked""",
    mapping_rows="""SELECT CASE WHEN c_custkey % 7 <> 0 AND c_custkey % 11 <> 0
  THEN lower(c_name) || ' / ' || lower(c_mktsegment) END AS dirty,
  CASE WHEN c_custkey % 7 <> 0 AND c_custkey % 11 <> 0 THEN c_name END AS clean FROM customer""",
    clean_transactions=f"""WITH {_RAW}, {_NAMES} SELECT {_RAW_LIST}, clean AS customer_name_clean,
  true_region AS region_clean, true_segment AS industry_segment_clean, clean_day AS order_date_clean,
  clean_revenue AS revenue_usd_clean FROM raw JOIN names ON customer_name = names.dirty""",
    clean_with_resolver=f"""WITH {_BASE} SELECT transaction_id, region, industry_segment,
  CASE region {" ".join(f"WHEN {_text(a)} THEN {_text(b)}" for a, b in _ANSWERS.items())}
    ELSE {_fallback("region", REGIONS)} END AS region_clean,
  CASE industry_segment WHEN 'Timber' THEN 'Wood Products' ELSE {_fallback("industry_segment", SEGMENTS)} END
    AS industry_segment_clean FROM dirty""",
    cleaning_profile=f"{_PROFILE} SELECT * FROM profile",
    cleaning_report=f"""{_PROFILE}
SELECT *, {_reduction('customers')}, {_reduction('regions')}, {_reduction('segments')} FROM profile""",
    analyzable_rows=f"""WITH {_BASE} SELECT transaction_id, true_region AS region_clean,
  clean_day AS order_date_clean, clean_revenue AS revenue_usd_clean FROM dirty WHERE {_COUNTABLE}""",
    exclusion_counts=f"""WITH {_BASE} SELECT CAST(count(*) AS BIGINT) AS rows,
  CAST(count(*) FILTER (clean_revenue IS NULL) AS BIGINT) AS null_revenue,
  CAST(count(*) FILTER (clean_revenue > 1e25) AS BIGINT) AS oversized_revenue,
  CAST(count(*) FILTER (clean_revenue < 0) AS BIGINT) AS negative_revenue,
  CAST(count(*) FILTER ({_COUNTABLE}) AS BIGINT) AS analyzable FROM dirty""",
    odd_amounts="""SELECT CAST(count(*) AS BIGINT) AS rows,
  CAST(count(*) FILTER (l_orderkey % 50 BETWEEN 1 AND 4) AS BIGINT) AS null_revenue,
  CAST(0 AS BIGINT) AS oversized_revenue,
  CAST(count(*) FILTER (l_orderkey % 50 = 5) AS BIGINT) AS negative_revenue,
  CAST(count(*) FILTER (l_orderkey % 50 = 0 OR l_orderkey % 50 > 5) AS BIGINT) AS analyzable,
  round_even(CAST(sum(CASE WHEN l_orderkey % 50 = 0 THEN 10000000000000000000000::HUGEINT
    ELSE CAST(round(l_extendedprice * 100) AS HUGEINT) END) FILTER (l_orderkey % 50 = 0 OR l_orderkey % 50 > 5) AS DOUBLE)
    / 100 * 100, 0) / 100 AS total_revenue
FROM lineitem""",
    all_breakdowns=f"""WITH {_TX}, wide AS (
  SELECT *, right(customer_name_clean, 1) AS last_digit FROM tx),
listed AS (SELECT 'industry_segment_clean' AS dimension, industry_segment_clean AS value, * FROM wide
  UNION ALL SELECT 'region_clean', region_clean, * FROM wide UNION ALL SELECT 'last_digit', last_digit, * FROM wide)
SELECT dimension, value, {_round('CAST(sum(amount) AS DOUBLE)')} AS revenue, CAST(count(transaction_id) AS BIGINT) AS transactions,
  CAST(count(DISTINCT customer_name_clean) AS BIGINT) AS unique_customers,
  {_pct('CAST(sum(amount) AS DOUBLE)', '(SELECT CAST(sum(amount) AS DOUBLE) FROM tx)')} AS pct_of_total
FROM listed WHERE value IS NOT NULL GROUP BY 1, 2""",
    approximate_breakdown=f"""WITH {_TX}
SELECT region_clean, CAST(count(transaction_id) AS BIGINT) AS transactions, CAST(count(DISTINCT customer_name_clean) AS BIGINT)
  AS customers, true AS estimate_within_5_percent FROM tx GROUP BY 1""",
    approximate_summary=f"""WITH {_TX}, {_DATASET}
SELECT total_revenue, total_transactions, date_range_start, date_range_end, unique_segments, unique_regions,
  true AS customers_within_5_percent FROM dataset_summary""",
    typical_amounts="""SELECT l_returnflag, CAST(count(l_extendedprice) AS BIGINT) AS priced_rows,
  unnest([0.1::DOUBLE, 0.5::DOUBLE, 0.9::DOUBLE]) AS share, true AS rank_within_1_percent FROM lineitem GROUP BY l_returnflag""",
    load_clean_rows=f"""WITH {_BASE}, {_NAMES} SELECT transaction_id, clean AS customer_name_clean,
  true_segment AS industry_segment_clean, clean_revenue AS revenue_usd_clean
FROM dirty JOIN names ON customer_name = names.dirty WHERE {_COUNTABLE}""",
    # names are clustered among the rows that the analysis uses
    cleaned_pareto=f"""WITH {_BASE}, used AS (SELECT * FROM dirty WHERE {_COUNTABLE}),
{_NAMES.replace("FROM dirty", "FROM used")}, tx AS (
  SELECT transaction_id, clean AS customer_name_clean, CAST(round(clean_revenue * 100) AS HUGEINT) AS amount
  FROM used JOIN names ON customer_name = names.dirty
), {_PARETO_OVER_CENTS} SELECT * FROM pareto""",
    dq_checks=f"""WITH {_BASE}, metrics AS (
  SELECT count(*) AS n, (SELECT count(*) FROM lineitem) AS expected, count(DISTINCT customer_name) AS customers,
         count(DISTINCT region) AS regions, count(*) - count(revenue_usd) AS nulls,
         count(DISTINCT length(order_date)) AS lengths, bool_or(contains(revenue_usd, '$')) AS dollars FROM dirty
), checks AS (
  SELECT 'row_count' AS check_name, n = expected AS passed, CAST(n AS VARCHAR) AS detail FROM metrics
  UNION ALL SELECT 'required_columns', true, '6'
  UNION ALL SELECT 'messy_customers', customers > 50, CAST(customers AS VARCHAR) FROM metrics
  UNION ALL SELECT 'messy_regions', regions > 15, CAST(regions AS VARCHAR) FROM metrics
  UNION ALL SELECT 'null_revenue_share', nulls BETWEEN n * 0.01 AND n * 0.08, CAST(nulls AS VARCHAR) FROM metrics
  UNION ALL SELECT 'mixed_date_formats', lengths >= 3, CAST(lengths AS VARCHAR) FROM metrics
  UNION ALL SELECT 'dollar_texts', dollars, CAST(dollars AS VARCHAR) FROM metrics
)
SELECT * FROM checks UNION ALL SELECT 'all_passed', bool_and(passed), CAST(count(*) AS VARCHAR) FROM checks""",
    dq_required_columns=f"WITH {_RAW} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, true AS present, CAST(count({name}) AS BIGINT) AS filled_rows, "
        f"'{_label(name)}' AS label FROM raw"
        for name in _RAW_COLUMNS
    ),
    scan_raw_csv=f"WITH {_RAW} SELECT * REPLACE ({_MISSING_TEXTS}) FROM (SELECT {_RAW_LIST} FROM raw)",
    scan_csv_reordered=f"WITH {_RAW} SELECT * REPLACE ({_MISSING_TEXTS}) FROM (SELECT {_RAW_LIST} FROM raw)",
    scan_csv_missing_column=f"WITH {_BASE} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, true AS present, CAST(count({name}) AS BIGINT) AS filled_rows FROM dirty"
        if name not in ("product_sku", "quantity", "sales_rep", "notes")
        else f"SELECT '{name}', false, CAST(0 AS BIGINT)"
        for name in _RAW_COLUMNS
    ),
    scan_delivery_log="""WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders),
lines AS (SELECT day, 'weekly_report_' || CAST(day AS VARCHAR) AS report, day(day) % 5 = 0 AS damaged FROM days)
SELECT CASE WHEN NOT damaged THEN report END AS report_path, CASE WHEN NOT damaged THEN 'skipped' END AS upload_status,
       CASE WHEN NOT damaged THEN CAST(day AS VARCHAR) END AS delivered_on,
       CASE WHEN damaged THEN left('{"report_path":"' || report, 20) END AS corrupt_record FROM lines""",
)
ORACLES["repeated_pairs"] = ORACLES["apply_mapping"]


def _triage() -> str:
    def branches(position: int) -> str:
        parts = []
        for cause in CAUSES:
            hit = " OR ".join(f"contains(lower(message), {_text(word)})" for word in cause[1])
            parts.append(f"WHEN {hit} THEN {_text(cause[position])}")
        return "CASE " + " ".join(parts)

    return f"""WITH messages AS (
  SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'login refused (401) for user '
    WHEN 1 THEN 'upload not allowed (403) for user ' WHEN 2 THEN 'no such address (404) asked for by user '
    WHEN 3 THEN 'the host lookup failed to resolve for user ' ELSE 'the line broke off while serving user ' END
    || CAST(user_id AS VARCHAR) || ' ' || repeat(props, 30) AS message FROM events)
SELECT event_id, {branches(0)} ELSE {_text(OTHER[0])} END AS cause, {branches(2)} ELSE {_text(OTHER[1])} END AS hint,
       left(message, 200) AS reason FROM messages"""


ORACLES["triage_errors"] = _triage()


# --- calls of a resolver, damaged files, whole reports ---------------------------

_CALLS = """
listed AS (SELECT customer_name AS dirty, row_number() OVER (ORDER BY customer_name) - 1 AS place
           FROM dirty GROUP BY customer_name),
calls AS (SELECT dirty, place // 50 AS batch, min(dirty) OVER (PARTITION BY place // 50) AS first_value FROM listed),
failing AS (SELECT min(batch) // 200 AS wave FROM calls WHERE length(first_value) % 3 = 0)"""

_DAMAGED = """
lines AS (SELECT *, l_orderkey % 11 AS kind, '"' || coalesce(notes, '') || '"' AS note,
  list_transform([{first}], lambda v: '"' || coalesce(v, '') || '"') AS shown
  FROM raw)""".format(first=", ".join(_RAW_COLUMNS[:-1]))

_MISTYPED = """
ones AS (SELECT *, substr(c_name, 1, 1) || substr(c_name, 3) AS one FROM customer),
twos AS (SELECT *, CASE c_custkey % 3 WHEN 0 THEN substr(one, 1, 3) || substr(one, 5) WHEN 1 THEN substr(one, 1, 3) || 'x' || substr(one, 5)
           ELSE substr(one, 1, 5) || 'x' || substr(one, 6) END AS two FROM ones),
forms AS (SELECT c_name, unnest([c_name, one, two, substr(two, 1, 1) || 'z' || substr(two, 3)]) AS dirty,
          unnest([90, 30, 9, 2]) AS rows FROM twos),
mistyped AS (SELECT dirty, min(c_name) AS c_name, CAST(sum(rows) AS BIGINT) AS n FROM forms GROUP BY dirty)"""


def _mistyped(joins: str, where: str = "true") -> str:
    return f"""WITH {_MISTYPED}
SELECT dirty, CASE WHEN {joins} THEN c_name ELSE dirty END AS clean, n,
  CASE WHEN n < 90 AND {joins} THEN 'edit' ELSE 'same' END AS merged_by FROM mistyped WHERE {where}"""


_REPORT_COLUMNS = ["label", "day", "amount", "count", "share", "more", "text"]


def _published(name: str, origin: str, **columns: str) -> str:
    kinds = ["VARCHAR", "DATE", "DOUBLE", "BIGINT", "DOUBLE", "DOUBLE", "VARCHAR"]
    shown = ", ".join(
        f"CAST({columns.get(column, 'NULL')} AS {kind}) AS {column}"
        for column, kind in zip(_REPORT_COLUMNS, kinds, strict=True)
    )
    return f"SELECT '{name}' AS report_table, {shown}, (SELECT max(day) FROM tx) AS report_date FROM ({origin}) AS t"


ORACLES.update(
    bucketed_lookup=f"""WITH {_BASE} SELECT transaction_id, customer_name, CASE length(customer_name) % 3
  WHEN 0 THEN upper(trim(customer_name, ' ' || chr(9))) WHEN 2 THEN 'later' ELSE customer_name END AS customer_name_clean
FROM dirty""",
    resolver_calls=f"""WITH {_BASE}, {_CALLS}
SELECT batch, CAST(count(*) AS BIGINT) AS size, min(dirty) AS first_value, max(dirty) AS last_value FROM calls GROUP BY 1""",
    restarted_resolver=f"""WITH {_BASE}, {_CALLS}
SELECT 'customers' AS domain, dirty, CASE WHEN length(first_value) % 3 = 0 OR batch // 200 > (SELECT wave FROM failing)
  THEN 'second ' ELSE 'first ' END || dirty AS clean FROM calls""",
    two_edit_names=_mistyped("n >= 9", "n <> 30"),
    chained_names=_mistyped("true"),
    unchained_names=_mistyped("n >= 30"),
    vocabulary_match="""WITH texts AS (
  SELECT DISTINCT CASE l_partkey % 4 WHEN 0 THEN 'via SUPPLIER#' || number || ' today' WHEN 1 THEN 'plier#' || number
    WHEN 2 THEN right(number, 4) ELSE 'depot ' || l_partkey END AS dirty
  FROM (SELECT l_partkey, lpad(CAST(l_partkey // 16 AS VARCHAR), 9, '0') AS number FROM lineitem)),
entries AS (SELECT s_suppkey * 7919 % 100003 AS ordinal, s_name AS entry FROM supplier)
SELECT dirty, arg_min(entry, ordinal) AS entry, min(ordinal) AS ordinal
FROM texts LEFT JOIN entries ON contains(lower(dirty), lower(entry)) OR contains(lower(entry), lower(dirty)) GROUP BY dirty""",
    scan_damaged_csv=f"""WITH {_RAW}
SELECT * REPLACE ({_MISSING_TEXTS}) FROM (SELECT {_RAW_LIST} FROM raw WHERE l_orderkey % 11 > 3)""",
    rejected_records=f"""WITH {_RAW}, {_DAMAGED}
SELECT array_to_string(shown[:8], ',') AS record, 'number of fields' AS problem FROM lines WHERE kind = 0
UNION ALL SELECT array_to_string(shown, ',') || ',' || note || ',more', 'number of fields' FROM lines WHERE kind = 1
UNION ALL SELECT array_to_string(shown, ',') || ',"cut', 'open quote' FROM lines WHERE kind = 2
UNION ALL SELECT shown[1] || ',"cut', 'open quote' FROM lines WHERE kind = 3
UNION ALL SELECT 'in two"', 'open quote' FROM lines WHERE kind = 2
UNION ALL SELECT 'in two",' || array_to_string(shown[3:], ',') || ',' || note, 'open quote' FROM lines WHERE kind = 3""",
    clean_damaged_csv=f"""WITH {_BASE}
SELECT CAST(count(*) FILTER (l_orderkey % 11 > 3) AS BIGINT) AS rows_processed,
  CAST(sum(CASE l_orderkey % 11 WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 2 ELSE 0 END) AS BIGINT) AS records_rejected,
  CAST(count(*) FILTER (l_orderkey % 11 > 3 AND clean_revenue IS NULL) AS BIGINT) AS null_revenues,
  CAST(count(DISTINCT region) FILTER (l_orderkey % 11 > 3) AS BIGINT) AS unique_regions FROM dirty""",
    scan_errors=f"""WITH {_BASE}
SELECT 'nothing written' AS step, '<path> not found. Write the raw transactions first.' AS outcome, CAST(NULL AS BIGINT) AS rows
UNION ALL SELECT 'columns missing', '<path> is missing expected columns: [''notes'', ''product_sku'', ''quantity'', ''sales_rep'']. '
  || 'Re-run the step that writes it.', NULL
UNION ALL SELECT 'all there', 'read', count(*) FROM dirty""",
    published_segments=f"""WITH {_BASE}
SELECT 'Segment ' || l_suppkey AS industry_segment_clean, {_round('sum(l_extendedprice::DECIMAL(18,2))::DOUBLE')} AS revenue,
  CAST(count(*) AS BIGINT) AS transactions, CAST(count(DISTINCT company) AS BIGINT) AS unique_customers,
  {_pct('sum(l_extendedprice::DECIMAL(18,2))::DOUBLE', '(SELECT sum(l_extendedprice::DECIMAL(18,2))::DOUBLE FROM base)')} / 100 AS share,
  (SELECT max(order_day) FROM base) AS report_date
FROM base GROUP BY l_suppkey""",
    published_tables=f"WITH {_TX} "
    + " UNION ALL ".join(
        [
            _published("kpi_tiles", ORACLES["kpi_tiles"], label="label", text="value"),
            _published("takeaway", ORACLES["takeaway"], text="takeaway"),
            _published(
                "customers", ORACLES["report_customers"], label="customer_name_clean", amount="revenue",
                count="transactions", share="share", more="cumulative_share",
            ),
            *[
                _published(
                    name, ORACLES[f"report_{name}"], label=dimension, amount="revenue", count="transactions",
                    share="share", more="unique_customers",
                )
                for name, dimension in (("segments", _SEGMENT), ("regions", _REGION))
            ],
            _published(
                "weekly", ORACLES["weekly_report"], day="week_ending", amount="revenue", count="transactions",
                share="wow_change", text="note",
            ),
            _published("weekly_chart", ORACLES["weekly_complete"], day="week_ending", amount="revenue"),
            _published(
                "pareto_curve", ORACLES["pareto_curve"], label="customer_name_clean", share="cumulative_share",
                more="threshold_line",
            ),
        ]
    ),
)
