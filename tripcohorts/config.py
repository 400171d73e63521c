"""Study settings. The two studies differ only in the values held here."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from tripcohorts.functions.cohorts import DateCohorts, MonthCohorts

# Labels, ids, thresholds and names the results depend on.
HOLIDAY = "Holiday Season"
BASELINE = "Normal Baseline"
COHORTS = (HOLIDAY, BASELINE)
AIRPORT_IDS = (1, 132, 138)
CARD_PAYMENT = 1
REAL_BOROUGHS = ("Manhattan", "Queens", "Brooklyn", "Bronx", "Staten Island")
NO_BOROUGH_TEXT = "N/A"
PROFILE_COLUMNS = ("fare_amount", "tip_amount", "trip_distance", "raw_tip_rate")
PROFILE_STATISTICS = ("count", "mean", "stddev", "min", "25%", "50%", "75%", "max")
PERCENTILES = (0.5, 0.75, 0.9, 0.95, 0.99)
PERCENTILE_ERROR = 0.01
TAIL_PERCENTILES = (0.95, 0.99, 0.995, 0.999, 0.9999)


# Fixed values, too: the defaults of the three classes below.
@dataclass(frozen=True)
class Thresholds:
    """Upper bounds of a usual trip, and lower bounds of an extreme tip."""

    fare_below: float = 100.0
    tip_below: float = 25.0
    distance_below: float = 25.0
    rate_at_most: float = 1.0
    extreme_tip: float = 20.0
    extreme_rate: float = 0.5


@dataclass(frozen=True)
class MonthStudy:
    """Month-set cohorts over whole years; card trips only."""

    cohorts: MonthCohorts = MonthCohorts(
        months={HOLIDAY: (11, 12, 1), BASELINE: (3, 4, 9, 10)},
        years=(2023, 2024, 2025),
    )
    airports: tuple[int, ...] = AIRPORT_IDS
    card_payment: int = CARD_PAYMENT
    thresholds: Thresholds = field(default_factory=Thresholds)
    boroughs: tuple[str, ...] = REAL_BOROUGHS
    control_min_trips: int = 10_000
    control_top: int = 20


@dataclass(frozen=True)
class DateStudy:
    """Inclusive date-range cohorts; all payment types until the card cut."""

    cohorts: DateCohorts = DateCohorts(
        ranges={
            BASELINE: (date(2025, 3, 1), date(2025, 3, 31)),
            HOLIDAY: (date(2025, 12, 1), date(2025, 12, 31)),
        }
    )
    airports: tuple[int, ...] = AIRPORT_IDS
    card_payment: int = CARD_PAYMENT
    thresholds: Thresholds = field(default_factory=Thresholds)
    zone_min_trips: int = 1_000
