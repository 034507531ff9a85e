"""clearbook: Spark-native cleaning and revenue-concentration analytics.

Every operator takes DataFrames and returns DataFrames (or takes Columns and
returns Columns); see the sub-packages:

* ``functions``  column expressions (dates, money, text, vocabularies)
* ``operators``  DataFrame operators (Pareto, breakdowns, weekly, cleaning, ...)
* ``sources``    scans, sinks, staged tables, the mapping table, publication
* ``plans``      whole jobs, the registered queries and their SQL twins
* ``streaming``  upkeep of the mapping table from arriving files
"""
