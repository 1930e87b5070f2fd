"""Business premises and physical knobs, in one place."""

from __future__ import annotations

from dataclasses import dataclass, replace
from decimal import Decimal


@dataclass(frozen=True)
class Params:
    # The default thresholds of the fraud and affiliate rules.
    qualified_baseline: Decimal = Decimal("50")
    low_play_ratio: Decimal = Decimal("0.2")
    max_ips: int = 10
    structuring_unit: int = 100
    structuring_min: int = 3
    device_min: int = 3
    registration_quantile: float = 0.9
    dormant_days: int = 60
    high_risk_score: int = 2
    lookback_days: int = 3
    # A key with several times this many rows is split over tasks (operators/skew.py).
    chunk_rows: int = 4_000_000

    def but(self, **changes) -> "Params":
        return replace(self, **changes)


DEFAULTS = Params()
