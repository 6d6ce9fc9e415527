"""Run parameters shared by the planning stages."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class PlanConfig:
    """Dates and constants of one planning run.

    ``as_of`` is the last day with actuals.  ``last_full_week`` is the Monday of
    the last complete week; the week after it is partial, so a forecast covers
    ``horizon_weeks + 1`` weeks.
    """

    as_of: str
    last_full_week: str
    calendar_start: str
    calendar_end: str
    fiscal_start_month: int = 4
    horizon_weeks: int = 12
    folds: int = 3
    min_train_weeks: int = 20
    share_weeks: int = 12
    naive_weight: float = 0.3
    service_z: float = 1.65
    review_weeks: int = 4
    default_lead_days: int = 14
    default_lead_weeks: float = 2.0
    band_default: tuple[float, float] = (0.6, 1.4)
    event_history_days: int = 60
    price_factor: float = 0.7
    reject_limit: float = 0.01
    reconcile_limit: float = 0.0001
