"""Column expressions built only from Spark's own functions (no UDFs)."""

from .casting import cast_expr, legacy_int

__all__ = ["cast_expr", "legacy_int"]
