"""Queries over the provided tables and the SQL each must agree with."""

from checks import area_clean, area_geo, area_io, area_ml, area_rollup, area_rules, area_series  # noqa: F401
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
