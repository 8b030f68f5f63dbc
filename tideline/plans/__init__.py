"""Registered queries and their oracles."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

MODULES = ("daily", "intraday", "manifest", "audit", "inputs", "live")


def _catalog():
    for m in MODULES:
        import_module(f"tideline.plans.{m}")
    return import_module("tideline.plans.catalog")


def market_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_catalog().QUERIES)


def market_oracles() -> dict[str, str]:
    return dict(_catalog().ORACLES)
