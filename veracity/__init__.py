"""Spark-native text-veracity analytics.

Sub-packages:

* ``functions`` – Column expressions (text cleaning, numbers, rules).
* ``sources``   – readers and writers (delimited / JSON articles, progress log, bundles).
* ``operators`` – DataFrame operators (spans, tokens, metrics, tuning, splits, pooling, models).
* ``plans``     – composed jobs (detection, end-to-end evaluation) and the driver queries.
* ``streaming`` – Structured Streaming variants of the stateless jobs.
"""

__version__ = "0.1.0"
