"""What the reports are run with; the defaults are those of monthly trip files."""

from __future__ import annotations

from dataclasses import dataclass

from milepost.functions.expressions import Period


@dataclass(frozen=True)
class Umbrales:
    """Review thresholds; they appear in the column names."""

    horas: int = 6
    millas: int = 100
    pasajeros: int = 8
    monto: int = 500


@dataclass(frozen=True)
class Settings:
    # Exploration and profile: files of this year (None = all files), pickups in this period.
    file_year: int | None = 2026
    period: Period = ("2026-01-01", "2027-01-01")
    quality_period: Period = ("2026-01-01", "2027-01-01")
    # Validation and comparison of years.
    years: tuple[int, ...] = (2024, 2026)
    expected_years: tuple[int, ...] = (2024, 2025, 2026)
    umbrales: Umbrales = Umbrales()
    sample_rows: int = 5
    top_routes: int = 10
    top_pairs: int = 20
    # Destinations: fewest trips, and how many from each end.
    min_trips: int = 10_000
    ends: int = 10
    service: str = "yellow"
    last_month: int = 8
    # Rounding of the comparison reports; None keeps the full double.
    digits: int | None = None
    # Points by which a monthly share moves before it is an alert.
    alert_change: float = 5.0
    # False takes quantiles from sketches, in one pass.
    exact: bool = True
