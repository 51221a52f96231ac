"""cohortwatch: prepare, profile, score and monitor tabular cohort data on Spark.

Every operator is a function ``DataFrame -> DataFrame`` (or a small driver-side
helper over a one-row-per-column aggregate). Column names are arguments; the
clinical column set is only one configuration of the library.
"""

__version__ = "0.1.0"
