"""valorem — a Spark-native engine for valuing listed entities.

Listing rows are extracted from stored pages, cleaned and rescaled, upserted
into a keyed master table, profiled, trimmed, and used to train per-segment
regressors on ``log1p(value)``; tables and message feeds are scored through
Spark SQL, Spark ML and Structured Streaming.

Sub-packages:

* ``functions``  column expressions (money/number/team/category parsing, HTML cells)
* ``sources``    table loading, the canonical master view, CSV / envelope sources and sinks
* ``operators``  profiling, reporting, trimming, scaling, upsert, validation, split
* ``plans``      model training / scoring jobs and the registry of queries
* ``streaming``  Structured Streaming scoring of the message feed
"""

__version__ = "0.1.0"
