"""Analyses by subject area.

Every module exposes ``QUERIES`` (name -> callable(spark, sf_dir)) and
``ORACLE`` (name -> DuckDB SQL over the stored tables). The analysis bodies
are plain functions of DataFrames so they run unchanged on fixtures.
"""

from __future__ import annotations

import importlib

AREAS = ("ret", "bnk", "clo", "wks", "clk", "seg", "sub", "dlv", "ops", "stored", "partials", "report")


def _load(area):
    try:
        return importlib.import_module(f"casebook.plans.{area}")
    except ModuleNotFoundError as e:
        if e.name == f"casebook.plans.{area}":
            return None
        raise


def all_queries() -> dict:
    out = {}
    for a in AREAS:
        m = _load(a)
        if m is not None:
            out.update(m.QUERIES)
    return out


def all_oracles() -> dict:
    out = {}
    for a in AREAS:
        m = _load(a)
        if m is not None:
            out.update(m.ORACLE)
    return out
