"""landstage: landing -> staging loads expressed as Spark DataFrame plans.

Subpackages
-----------
functions  column expressions (hashes, tolerant casts, date parsing, audit stamps)
operators  DataFrame -> DataFrame steps (dedupe, lookup, unpivot, nesting, record maps)
sources    readers (catalog tables, path sets, JDBC, file discovery)
sinks      writers (tables, Parquet, JSON documents, tree copy)
plans      declarative load specs, the staging model's loads, job shapes, the job
           runner, and the registered queries over the shared test tables
streaming  incremental (bookmarked) runs of the same specs
"""

__version__ = "0.1.0"
