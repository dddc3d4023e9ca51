"""All registered queries and oracles of the library."""

from . import queries, queries_audit, queries_catalog, queries_commands  # noqa: F401

QUERIES, ORACLES = queries.QUERIES, queries.ORACLES
