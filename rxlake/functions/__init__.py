"""Column-level functions."""

from rxlake.functions.codes import normalize_code, register_sql_function
from rxlake.functions.columns import snake_case_columns

__all__ = ["normalize_code", "register_sql_function", "snake_case_columns"]
