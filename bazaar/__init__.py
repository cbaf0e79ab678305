"""bazaar: retail order analytics expressed as Spark DataFrame / SQL jobs.

Layout
------
functions/  Column -> Column expressions (parsing, text, formatting, bands)
operators/  DataFrame -> DataFrame jobs (cleaning, defect injection, dimensions,
            reports, statistics, key checks)
sources/    readers and writers (raw CSV, clean Parquet, warehouse tables, the
            driver's star tables and the views built on them)
plans/      the query catalogue (Spark + oracle SQL) and the stage runner
streaming/  (empty on purpose: the workload is batch only)
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
