from surveyspark.functions import codebooks
from surveyspark.functions.expressions import (
    any_null, fmt, hex_threshold, is_missing, is_missing_col, key_hash, pct_deviation, round6, safe_div,
)

__all__ = ["codebooks", "any_null", "fmt", "hex_threshold", "is_missing", "is_missing_col", "key_hash",
           "pct_deviation", "round6", "safe_div"]
