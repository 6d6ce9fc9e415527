"""Split-conformal bands from backtest ratios."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeplan.session import measured

ACCURACY = 100000


def ratios(bt: DataFrame, floor: float = 0.5) -> DataFrame:
    return bt.where(F.col("fc") > floor).withColumn("ratio", F.col("actual") / F.col("fc"))


def quantiles(df: DataFrame, groups: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Group quantiles from mergeable sketches: map-side, no group is collected."""
    return df.groupBy(*groups).agg(*[
        F.percentile_approx(value, p, ACCURACY).alias(name) for name, p in probs.items()])


def calibrate(bt: DataFrame, groups: list[str], lo: float = 0.1, hi: float = 0.9) -> DataFrame:
    return quantiles(ratios(bt), groups, "ratio", {"q_lo": lo, "q_hi": hi})


def apply_bands(df: DataFrame, bands: DataFrame, groups: list[str], default: tuple[float, float]) -> DataFrame:
    """Lower and upper bound; groups without calibration get the default band."""
    return (
        df.join(measured(bands, "bands"), groups, "left")
        .fillna({"q_lo": default[0], "q_hi": default[1]})
        .withColumns({"lower": F.col("fc") * F.col("q_lo"), "upper": F.col("fc") * F.col("q_hi")})
    )


def holdout_coverage(bt: DataFrame, groups: list[str]) -> DataFrame:
    """One row: coverage on the last fold with bands from the earlier folds."""
    usable = ratios(bt)
    last = usable.select(F.max("cutoff").alias("c")).scalar()
    bands = quantiles(usable.where(F.col("cutoff") < last), groups, "ratio", {"q_lo": 0.1, "q_hi": 0.9})
    inside = F.col("actual").between(F.col("fc") * F.col("q_lo"), F.col("fc") * F.col("q_hi"))
    return (
        usable.where(F.col("cutoff") == last).join(measured(bands, "bands"), groups)
        .agg(F.avg(inside.cast("int")).alias("coverage"), F.count(F.lit(1)).alias("points"))
    )
