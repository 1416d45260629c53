"""Operators of a training-data pipeline. Nothing outside this subpackage imports it."""

from . import catalog


def queries():
    return dict(catalog.QUERIES)


def oracle_sql():
    return dict(catalog.ORACLE)
