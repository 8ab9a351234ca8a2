"""Interest tariff: balance tiers plus a loan bonus."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal


@dataclass(frozen=True)
class Tariff:
    # Fixed values (must equal the reference's rate card):
    #   balance < 10000            -> 0.01
    #   10000 <= balance <= 20000  -> 0.015
    #   balance > 20000            -> 0.02
    #   customer has a loan        -> +0.005
    tier_1_rate: Decimal = Decimal("0.01")
    tier_2_rate: Decimal = Decimal("0.015")
    tier_3_rate: Decimal = Decimal("0.02")
    loan_bonus_rate: Decimal = Decimal("0.005")
    tier_2_floor: Decimal = Decimal("10000")
    tier_2_ceiling: Decimal = Decimal("20000")


DEFAULT_TARIFF = Tariff()
