"""Registered queries: a Spark plan, the equivalent SQL, and one column list that shapes both results.

Column kinds: ``i`` integer, ``s`` text, ``d`` date as text, ``t`` timestamp as text, ``f`` double cut to
six decimals, ``g`` double cut to two. Doubles are cut as floor(x * scale + offset) / scale with an offset
that decimal data does not hit, so sums taken in another order cut to the same value.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattframe.plans.views import SQL_VIEWS, Tables

OFFSET = 0.3719264
SCALE = {"f": 1_000_000.0, "g": 100.0}


@dataclass(frozen=True)
class Query:
    name: str
    columns: tuple[tuple[str, str], ...]
    plan: Callable[[Tables], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.plan(Tables(spark, sf_dir))
        return df.select(*[self._spark_cell(n, k) for n, k in self.columns])

    @staticmethod
    def _spark_cell(name: str, kind: str):
        c = F.col(name)
        if kind in SCALE:
            cut = F.floor(c.cast("double") * SCALE[kind] + OFFSET) / SCALE[kind]
        elif kind == "i":
            cut = c.cast("bigint")
        elif kind == "t":
            cut = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        else:
            cut = c.cast("string")
        return cut.alias(name)

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        cells = []
        for name, kind in self.columns:
            c = f'"{name}"'
            if kind in SCALE:
                cells.append(f"floor(CAST({c} AS DOUBLE) * {SCALE[kind]:.1f} + {OFFSET}) / {SCALE[kind]:.1f} AS {c}")
            elif kind == "i":
                cells.append(f"CAST({c} AS BIGINT) AS {c}")
            elif kind == "t":
                cells.append(f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}")
            else:
                cells.append(f"CAST({c} AS VARCHAR) AS {c}")
        needed = _views_used(self.sql)
        ctes = [f"{v} AS ({SQL_VIEWS[v]})" for v in needed]
        prefix = f"WITH {', '.join(ctes)} " if ctes else ""
        return f"{prefix}SELECT {', '.join(cells)} FROM ({self.sql}) AS result"


def _views_used(sql: str) -> list[str]:
    """Views a statement needs, in definition order, with the views those need."""
    wanted: set[str] = set()
    todo = [sql]
    while todo:
        words = set(re.findall(r"\bv_\w+", todo.pop()))
        for view in words & SQL_VIEWS.keys() - wanted:
            wanted.add(view)
            todo.append(SQL_VIEWS[view])
    return [v for v in SQL_VIEWS if v in wanted]


QUERIES: dict[str, Query] = {}


def query(name: str, columns: str, sql: str | None = None):
    """Register a plan under a name; ``columns`` lists ``name:kind`` pairs."""
    spec = tuple(tuple(c.split(":")) for c in columns.split())

    def register(plan: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = Query(name, spec, plan, sql)
        return plan

    return register


MODULES = (
    "ask_basics", "ask_repair", "ask_similar", "ask_corrections", "ask_decisions", "ask_quality", "ask_sources", "ask_streams", "ask_writes",
)


def load_all() -> dict[str, Query]:
    for module in MODULES:
        import_module(f"wattframe.plans.{module}")
    return QUERIES
