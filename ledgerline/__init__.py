"""ledgerline -- batch data operators and pipelines on Spark DataFrames.

Modules:

* :mod:`ledgerline.session` -- session defaults and the shared work folder
* :mod:`ledgerline.sources` -- CSV / JSON / NDJSON / Parquet / catalog / rows / generator
* :mod:`ledgerline.functions` -- column expressions
* :mod:`ledgerline.operators` -- filters, dedup, aggregates, joins, layout, profiles
* :mod:`ledgerline.sinks` -- partitioned / compacted files, JDBC, empty guard
* :mod:`ledgerline.plans` -- the four pipelines and the registered queries
"""

__version__ = "0.1.0"
