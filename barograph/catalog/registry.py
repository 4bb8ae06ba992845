"""Registry of the queries and of the SQL that states their result."""

from __future__ import annotations

from collections.abc import Callable
from contextvars import ContextVar
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from barograph.params import SeriesSpec

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


#: Rows of a block while a query runs on its distributed path; None: as its series asks.
_block_rows: ContextVar[int | None] = ContextVar("block_rows", default=None)
#: Blocks shorter than the series of the smallest tables.
SMALL = 128


def laid_out(spec: SeriesSpec) -> SeriesSpec:
    """The series with the block length that the running query is registered with."""
    rows = _block_rows.get()
    return spec if rows is None else replace(spec, block_rows=rows)


def query(sql: str | None = None, blocks: int | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL if it has one.

    With ``blocks`` it is registered once more, as ``<name>_blocks``: the same operators on blocks of so many rows,
    which is the path of series too long for one task, with the same SQL.
    """

    def add(fn: Query) -> Query:
        def in_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
            token = _block_rows.set(blocks)
            try:
                return fn(spark, sf_dir)
            finally:
                _block_rows.reset(token)

        made = {fn.__name__: fn} | ({f"{fn.__name__}_blocks": in_blocks} if blocks else {})
        QUERIES.update(made)
        if sql is not None:
            ORACLES.update(dict.fromkeys(made, sql))
        return fn

    return add
