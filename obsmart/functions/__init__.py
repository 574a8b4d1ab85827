"""Column expressions shared by the models."""
from obsmart.functions.numeric import daynum, hours_between, pct, ratio, rounded, tenths

__all__ = ["daynum", "hours_between", "pct", "ratio", "rounded", "tenths"]
