"""Record-level cohort analytics on Spark DataFrames.

Every operator takes DataFrames and returns lazy DataFrames unless its docstring says that it runs a job.
Rows are identified by ``key`` columns; the default is a person and a year.
"""

DEFAULT_KEY = ("person_id", "app_year")
