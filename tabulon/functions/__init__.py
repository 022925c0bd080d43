from tabulon.functions.columns import (
    all_of, any_of, is_float_type, is_infinite, is_missing, is_numeric_type, nan_ratio,
    numeric_columns, ratio_or, safe_ratio, string_columns, vector_element,
)

__all__ = [
    "all_of", "any_of", "is_float_type", "is_infinite", "is_missing", "is_numeric_type",
    "nan_ratio", "numeric_columns", "ratio_or", "safe_ratio", "string_columns", "vector_element",
]
