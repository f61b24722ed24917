"""omoplate: OMOP CDM conversion as lazy Spark DataFrame operators.

Layout
------
functions/  column-level helpers (dates, text, numbers)
operators/  DataFrame -> DataFrame operators (conformance, intervals, visits,
            vocabulary mapping, integrity checks)
sources/    readers and writers (delimited text, parquet, vocabulary files)
plans/      one pipeline per OMOP output table
streaming/  micro-batch driver for the per-file standardisation step
"""

__version__ = "0.1.0"
