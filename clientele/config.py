"""Settings of the weekly and daily jobs."""

from __future__ import annotations

from dataclasses import dataclass

# Model type tags used in model names.
BGNBD = "BGNBD"
PARETO = "PARETO"
GAMMA_GAMMA = "ggf"

# Periods per month for each summary frequency.
PERIODS_PER_MONTH = {"D": 30.0, "W": 4.345, "M": 1.0}

# Length in days of one period (M is the mean Gregorian month).
DAYS_PER_PERIOD = {"D": 1.0, "W": 7.0, "M": 30.436875}


def check_frequency(frequency: str) -> str:
    """Return the frequency in upper case, or raise when it is not D, W or M."""
    tag = frequency.upper()
    if tag not in PERIODS_PER_MONTH:
        raise ValueError(f"frequency must be D, W or M, not {frequency!r}")
    return tag


def horizon(frequency: str, months: float) -> float:
    """Forecast length in periods: ``months`` expressed at the given frequency."""
    return months * PERIODS_PER_MONTH[check_frequency(frequency)]


@dataclass(frozen=True)
class ScoringConfig:
    """Defaults of the two jobs; every field can be overridden."""

    penalizer: float = 0.03
    discount_rate: float = 0.01
    months: int = 6
    model_type: str = BGNBD
    frequency: str = "M"
    model_prefix: str = "clv_model"
    business_zone: str = "Europe/Copenhagen"
    recent_months: int = 24
    changed_days: int = 1
    min_orders: int = 2
    min_recent_orders: int = 1
    returns: str = "per_date"
    # Size that a ledger table counts as when its source cannot tell it.
    unknown_bytes: int = 0
    # Save and publish models whose fit did not converge.
    allow_unconverged: bool = False
    # Cut value segments by mergeable quantile sketches instead of exact percentiles.
    approximate_cuts: bool = False
