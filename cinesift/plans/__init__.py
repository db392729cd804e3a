"""Registered queries over the benchmark tables and their DuckDB SQL oracles."""

from cinesift.plans.oracle import ORACLE_SQL
from cinesift.plans.queries import QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
