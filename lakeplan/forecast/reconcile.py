"""Top-down reconciliation, candidate blends and champion selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeplan.operators.joins import trailing_join
from lakeplan.operators.windows import share_of

NAIVE = "seasonal_naive"


def candidates(naive_weight: float = 0.3) -> dict[str, str]:
    """Candidate name to expression over direct, topdown and seasonal_naive."""
    w, v = 1 - naive_weight, naive_weight
    return {
        "direct": "direct",
        "topdown": "topdown",
        "combined": "(direct + topdown) / 2",
        "direct+snaive": f"{w}D * direct + {v}D * seasonal_naive",
        "topdown+snaive": f"{w}D * topdown + {v}D * seasonal_naive",
        "combined+snaive": f"{w}D * (direct + topdown) / 2 + {v}D * seasonal_naive",
        NAIVE: "seasonal_naive",
    }


def column_of(name: str) -> str:
    return "c_" + name.replace("+", "_")


def trailing_share(cutoffs: DataFrame, grid: DataFrame, parent: str, weeks: int = 12) -> DataFrame:
    """Share of a SKU in its parent within the zone over the weeks up to each cutoff."""
    units = trailing_join(cutoffs, grid, weeks).groupBy("cutoff", "sku_id", "zone", parent).agg(
        F.sum("units").alias("units"))
    return share_of(units, "units", ["cutoff", parent, "zone"]).drop("units")


def top_down(child: DataFrame, parent: DataFrame, share: DataFrame, parent_key: str) -> DataFrame:
    """Parent forecast x share; the direct forecast where either is missing."""
    up = parent.select(parent_key, "zone", "cutoff", "week_start", F.col("yhat").alias("_up"))
    part = share.select("sku_id", "zone", "cutoff", F.col("share").alias("_share"))
    return (
        child.join(part, ["sku_id", "zone", "cutoff"], "left")
        .join(up, [parent_key, "zone", "cutoff", "week_start"], "left")
        .withColumn("topdown", F.coalesce(F.col("_up") * F.col("_share"), F.col("direct")))
        .drop("_up", "_share")
    )


def blend(df: DataFrame, naive_weight: float = 0.3) -> DataFrame:
    return df.withColumns({column_of(n): F.expr(e) for n, e in candidates(naive_weight).items()})


def wape_by_candidate(bt: DataFrame, level: str) -> DataFrame:
    """(level, candidate, wape) from one aggregate over the wide table."""
    names = list(candidates())
    total = F.nullif(F.sum("actual"), F.lit(0.0))
    wide = bt.agg(*[
        (F.round(F.sum(F.abs(F.col("actual") - F.col(column_of(n)))), 6) / total).alias(column_of(n)) for n in names])
    entry = F.array(*[F.struct(F.lit(n).alias("candidate"), F.col(column_of(n)).alias("wape")) for n in names])
    return wide.select(F.lit(level).alias("level"), F.inline(entry))


def to_parent(bt: DataFrame, parent: str) -> DataFrame:
    cols = ["actual", *[column_of(n) for n in candidates()]]
    return bt.groupBy(parent, "zone", "cutoff", "week_start").agg(*[F.sum(c).alias(c) for c in cols])


def champion(wapes: DataFrame) -> DataFrame:
    """The one row of lowest error; the naive baseline cannot win, equal errors go by name."""
    return wapes.where(F.col("candidate") != NAIVE).orderBy("wape", "candidate").limit(1)


def comparison(bt: DataFrame, parent: str, child_level: str, parent_level: str) -> DataFrame:
    """Leaderboard on both levels; the champion is chosen on the child level."""
    child = wape_by_candidate(bt, child_level)
    winner = champion(child).select("candidate").scalar()
    both = child.unionByName(wape_by_candidate(to_parent(bt, parent), parent_level))
    return both.withColumn("is_champion", F.col("candidate") == winner)


def chosen(winner: Column) -> Column:
    """The champion's forecast column, picked by a scalar that Spark evaluates."""
    return F.coalesce(*[F.when(winner == n, F.col(column_of(n))) for n in candidates()])
