"""Parallel reads of a database table over ranges of a column that hold about equal numbers of rows.

Ranges of equal width would be as uneven as the ids: text keys, gaps after deletions, one busy
prefix. So the database counts rows per cell of the column first; cells with too many rows are
counted again in finer cells, and ranges are cut at cell borders. Each range is one task and one
connection, and its predicate is a plain comparison that an index answers.
"""

from __future__ import annotations

import math
import os
from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame, SparkSession

#: Cells per range that are counted: the finer, the more even are the ranges.
CELLS = 16
#: How often a cell with too many rows is split again.
REFINEMENTS = 8

Run = Callable[[str], list[tuple]]


@dataclass(frozen=True)
class Cell:
    """The smallest and the largest value of some neighbouring rows, and their number."""

    low: Any
    high: Any
    n: int


def literal(value: Any, backslash: bool = False) -> str:
    """A value as SQL text; ``backslash`` for databases in whose text a backslash escapes."""
    if isinstance(value, bool) or not isinstance(value, int | float | Decimal | str):
        raise TypeError(f"ranges need numbers or text, not {type(value).__name__}")
    if isinstance(value, str):
        text = value.replace("\\", "\\\\") if backslash else value
        return "'" + text.replace("'", "''") + "'"
    return str(value)


def bounds_query(table: str, column: str) -> str:
    return f"SELECT MIN({column}), MAX({column}), COUNT({column}) FROM {table}"


def cells_query(table: str, column: str, cell: Cell, cells: int, backslash: bool = False) -> str:
    """Smallest, largest and number of rows per part of a cell, in the database's own order."""
    if isinstance(cell.low, str):
        # All values between two texts share what these have in common at their start.
        part = f"SUBSTR({column}, 1, {len(os.path.commonprefix([cell.low, cell.high])) + 2})"
    else:
        width = max(1, math.ceil((cell.high - cell.low + 1) / cells))
        part = f"FLOOR(({column} - {literal(cell.low)}) / {width})"
    low, high = literal(cell.low, backslash), literal(cell.high, backslash)
    return (
        f"SELECT MIN({column}), MAX({column}), COUNT(*) FROM {table} "
        f"WHERE {column} >= {low} AND {column} <= {high} GROUP BY {part} ORDER BY 1"
    )


def count_cells(
    run: Run, table: str, column: str, partitions: int, backslash: bool = False
) -> list[Cell]:
    """Cells of the whole column in order, of about a CELLS-th of a range each where values allow."""
    low, high, n = run(bounds_query(table, column))[0]
    if not n:
        return []
    cells, most = [Cell(low, high, int(n))], max(1, n // partitions // 2)
    for _ in range(REFINEMENTS):
        finer: list[Cell] = []
        for cell in cells:
            if cell.n <= most or cell.low == cell.high:
                finer.append(cell)
                continue
            wanted = max(2, math.ceil(CELLS * partitions * cell.n / n))
            parts = run(cells_query(table, column, cell, wanted, backslash))
            finer += [Cell(a, b, int(c)) for a, b, c in parts]
        if len(finer) == len(cells):
            break
        cells = finer
    return cells


def cut(cells: list[Cell], partitions: int) -> list[Any]:
    """Borders between at most ``partitions`` ranges: each closes with the cell that brings it to
    its share of the rows, or before it where that is closer."""
    total, borders, done = sum(c.n for c in cells), [], 0
    for before, cell in zip(cells, cells[1:]):
        done += before.n
        goal = total * (len(borders) + 1) / partitions
        if len(borders) < partitions - 1 and (done >= goal or goal - done < done + cell.n - goal):
            borders.append(cell.low)
    return borders


def range_predicates(column: str, borders: list[Any], backslash: bool = False) -> list[str]:
    """One condition per range; together they hold for every row once, nulls included."""
    texts = [literal(b, backslash) for b in borders]
    if not texts:
        return ["1 = 1"]
    first = f"({column} < {texts[0]} OR {column} IS NULL)"
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(texts, texts[1:])]
    return [first, *inner, f"{column} >= {texts[-1]}"]


def plan_ranges(
    run: Run, table: str, column: str, partitions: int, backslash: bool = False
) -> list[str]:
    """Predicates of at most ``partitions`` ranges. ``run`` asks the database: one query for the
    bounds, one for the cells, and some for cells that hold too much."""
    if partitions < 1:
        raise ValueError("partitions must be 1 at least")
    cells = count_cells(run, table, column, partitions, backslash)
    return range_predicates(column, cut(cells, partitions), backslash)


def read_ranges(
    spark: SparkSession, url: str, table: str, column: str, partitions: int, **options: str
) -> DataFrame:
    """A database table, a task per range of ``column``."""
    settings = {"fetchsize": "10000", **options}

    def run(query: str) -> list[tuple]:
        reader = spark.read.format("jdbc").options(url=url, query=query, **settings)
        return [tuple(r) for r in reader.load().collect()]

    backslash = url.startswith(("jdbc:mysql:", "jdbc:mariadb:"))
    predicates = plan_ranges(run, table, column, partitions, backslash)
    return spark.read.jdbc(url, table, predicates=predicates, properties=settings)
