import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id long, text string, lang string, source string, n_chars int"


def docs_of(spark, rows):
    """documents rows from (doc_id, text) or (doc_id, text, lang)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS)
