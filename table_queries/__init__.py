"""Queries over the driver tables, each with the SQL that gives the same rows."""

from table_queries import (
    datasets,
    payloads,
    posts,
    relations,
    reports,
    scalars,
    storage,
    streams,
)

_MODULES = [scalars, relations, reports, payloads, posts, datasets, storage, streams]

QUERIES = {}
ORACLE = {}
for _module in _MODULES:
    QUERIES.update(_module.registry.queries)
    ORACLE.update(_module.registry.oracle)
