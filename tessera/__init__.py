"""tessera: DataFrame-to-DataFrame analytics operators on Spark SQL.

Layout
------
sources/    scans, schema listings, sinks
functions/  column-expression helpers (text, dates, binning, hashing, small stats)
operators/  the analytics operators (profiling, sampling, ranking, text pairs,
            cohorts, descriptive tables, survival, models, clustering, recommender)
plans/      fixture views over the test tables and the named query catalogue
streaming/  (no streaming workload exists in the reference; see README)
"""

__version__ = "0.1.0"
