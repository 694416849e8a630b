"""DataFrame -> DataFrame operators. Column names are parameters; nothing is collected
except report-sized results (class lists, model summaries)."""

from surveyspark.operators import aggregates, columns, impute, metrics, ml, recode, reshape, sampling

__all__ = ["aggregates", "columns", "impute", "metrics", "ml", "recode", "reshape", "sampling"]
