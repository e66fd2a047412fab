"""All registered queries."""

import importlib

from tidemark.catalog.registry import QUERIES, SQL

for _name in "relational streams text ratings vectors classes evaluation flow signals files".split():
    importlib.import_module(f"tidemark.catalog.{_name}")

__all__ = ["QUERIES", "SQL"]
