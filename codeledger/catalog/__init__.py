"""Every operator as a named query over the driver tables, with SQL to check it."""

from __future__ import annotations

from importlib import import_module

from codeledger.catalog.registry import ORACLE, QUERIES

for _module in ("portfolio", "scanners", "contents", "assembly", "storage", "configuration"):
    import_module(f"codeledger.catalog.{_module}")


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLE)
