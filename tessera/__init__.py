"""tessera: DataFrame-in / DataFrame-out analytics operators on Apache Spark.

Sub-packages
------------
sources    readers and writers (CSV/JSON/text/binary catalogues, Parquet phases, BI exports)
functions  Column -> Column helpers (dates, binning rules, text features)
operators  DataFrame -> DataFrame operators (cleaning, profiling, joins, windows,
           sampling, recommenders, evaluation, masks, ML wrappers)
plans      composed, registered queries over the driver tables
streaming  Structured Streaming versions of the row-local and windowed operators
"""

__version__ = "0.1.0"
