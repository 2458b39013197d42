"""churnkit: churn and propensity analytics written as Spark DataFrame jobs.

Modules
-------
sources     table loading, fixture views, writers
functions   Column -> Column helpers (labels, dates, hashing, safe arithmetic)
operators   DataFrame -> DataFrame operators (profiling, dedup, joins, metrics,
            evaluation, sampling, splits, feature impact, leaderboard,
            correlation clustering, Spark ML jobs, drift)
plans       end-to-end flows and the query catalog used by ``__spark_entry__``
streaming   stateless scoring of streaming DataFrames
"""

__version__ = "0.1.0"
