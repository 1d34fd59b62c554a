"""eventlake: travel-site funnel events on Spark.

Day files -> typed table -> deduplicated table -> serving table, as
DataFrame / Spark SQL jobs (``plans.runs.recent``, ``plans.runs.historic``)
or an available-now stream (``streaming.incremental``).

Subpackages: ``functions`` (scalar rules, date ranges), ``sources`` (day
files, the test fixture), ``operators`` (typed projection, deduplication,
tables, serving), ``plans`` (runs, registered queries, oracles),
``streaming`` (incremental load).
"""

__version__ = "0.1.0"
