"""All queries of the reference's operators with their SQL oracles."""

from __future__ import annotations

from functools import partial

from .plans import queries as library
from .plans import relational


def queries() -> dict:
    plain = {k: partial(lambda spark, sf_dir, name: relational.run(spark, sf_dir, name), name=k) for k in relational.SQL}
    return plain | library.QUERIES


def oracle_sql() -> dict[str, str]:
    return {k: relational.oracle(k) for k in relational.SQL} | library.ORACLE
