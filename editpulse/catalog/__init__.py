"""Registered queries: each operator on the driver's tables, with the SQL that
must give the same rows where SQL can state it."""

from editpulse.catalog import (
    aggregates, features, history, kpis, models, quality, rows, sources, streams, tables,
)

MODULES = (sources, rows, aggregates, features, kpis, quality, streams, history, models, tables)


def queries():
    return {name: fn for m in MODULES for name, (fn, _) in m.QUERIES.items()}


def oracle_sql():
    return {name: sql for m in MODULES for name, (_, sql) in m.QUERIES.items() if sql}
