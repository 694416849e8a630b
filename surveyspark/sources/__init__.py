from surveyspark.sources.files import (
    path_exists, read_csv, read_csv_file, read_report, resolve_source, write_csv, write_report,
)
from surveyspark.sources.models import load_model, save_model
from surveyspark.sources.testdata import TABLES, documents_labels, survey, table

__all__ = ["path_exists", "read_csv", "read_csv_file", "read_report", "resolve_source", "write_csv", "write_report",
           "load_model", "save_model", "TABLES", "documents_labels", "survey", "table"]
