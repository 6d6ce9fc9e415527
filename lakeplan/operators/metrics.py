"""Governed KPI views: dimensions and measures by name, aggregated at the grain a query asks for."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeplan.operators.filters import matches
from lakeplan.operators.joins import broadcast_if_small


@dataclass(frozen=True)
class Field:
    """A named SQL expression over ``source`` and the join aliases."""

    name: str
    expr: str
    comment: str = ""
    synonyms: tuple[str, ...] = ()


@dataclass(frozen=True)
class ViewJoin:
    """A left many-to-one join; the right side has one row per key."""

    df: DataFrame
    on: str


@dataclass
class MetricView:
    source: DataFrame
    dims: list[Field]
    measures: list[Field]
    joins: dict[str, ViewJoin] = field(default_factory=dict)
    where: str | None = None
    comment: str = ""

    def __post_init__(self):
        self._names = {}
        for f in [*self.dims, *self.measures]:
            for n in (f.name, *f.synonyms):
                if n.lower() in self._names:
                    raise ValueError(f"name used twice: {n}")
                self._names[n.lower()] = f

    def find(self, name: str) -> Field:
        try:
            return self._names[name.lower()]
        except KeyError:
            raise KeyError(f"no dimension or measure named {name!r}") from None

    def _joined(self, exprs: list[str]) -> DataFrame:
        """Source with only the joins whose alias occurs in the expressions or in the view's own filter."""
        df = self.source.alias("source")
        exprs = [*exprs, self.where or ""]
        for alias, j in self.joins.items():
            if any(re.search(rf"\b{re.escape(alias)}\.", e) for e in exprs):
                df = df.join(broadcast_if_small(j.df).alias(alias), F.expr(j.on), "left")
        return df.where(self.where) if self.where else df

    def query(self, dims: list[str], measures: list[str], where: dict[str, object] | None = None,
              order: list[Column | str] | None = None, limit: int | None = None) -> DataFrame:
        """Measures by dimensions.  ``where`` maps a dimension to a value, a list of values or a Range."""
        by = [self.find(n) for n in dims]
        what = [self.find(n) for n in measures]
        cond = {self.find(n).expr: v for n, v in (where or {}).items()}
        df = self._joined([f.expr for f in (*by, *what)] + list(cond))
        for expr, wanted in cond.items():
            df = df.where(matches(F.expr(expr), wanted))
        out = df.groupBy(*[F.expr(f.expr).alias(n) for f, n in zip(by, dims)]).agg(
            *[F.expr(f.expr).alias(n) for f, n in zip(what, measures)])
        if order:
            out = out.orderBy(*order)
        return out if limit is None else out.limit(limit)
