"""A folder for intermediate data where the session names none (tests, local runs)."""

from stockpolicy.functions.session import ensure_workspace

__all__ = ["ensure_workspace"]
