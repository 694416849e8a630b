"""surveyspark: survey microdata analytics as parameterised Spark DataFrame operators.

Layout
------
sources/    CSV / report / model readers and writers, test-table loaders and the survey fixture
functions/  Column-level helpers (missing test, key hash, formatting) and fixed code books
operators/  DataFrame -> DataFrame operators: columns, recoding, aggregates, reshaping,
            sampling, imputation, classification metrics, Spark ML wrappers
plans/      Composite jobs (extract, impute, analyse, cluster, train, audit) and the
            registry of named queries used by ``__spark_entry__``
streaming/  Structured Streaming scoring of incoming answer records
"""

from surveyspark.session import get_spark, scratch_path

__all__ = ["get_spark", "scratch_path"]
