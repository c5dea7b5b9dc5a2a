"""Imports every module that registers queries."""

from collatio.plans import derived, literals, pages, tables, text  # noqa: F401
from collatio.plans.registry import ORACLES, QUERIES  # noqa: F401
