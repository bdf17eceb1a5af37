"""Business parameters: rates, statuses, spend, tolerances."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from decimal import Decimal
from pathlib import Path
from typing import Any

# Gateway fee per payment type, as a fraction of the amount paid.
FEE_RATES = {
    "credit_card": Decimal("0.025"),
    "debit_card": Decimal("0.015"),
    "upi": Decimal("0.005"),
    "voucher": Decimal("0.000"),
}
DEFAULT_FEE_RATE = Decimal("0.020")

# Estimated marketing spend per channel and month.
MONTHLY_SPEND = {
    "marketplace": Decimal("45000"),
    "organic_search": Decimal("0"),
    "paid_search": Decimal("60000"),
    "social_ads": Decimal("35000"),
    "email": Decimal("8000"),
    "referral": Decimal("5000"),
}

# Source file of each raw table.
CSV_FILES = {
    "orders": "orders.csv",
    "order_items": "order_items.csv",
    "order_payments": "order_payments.csv",
    "customers": "customers.csv",
    "products": "products.csv",
    "marketing_qualified_leads": "marketing_qualified_leads.csv",
    "closed_deals": "closed_deals.csv",
}

# Least number of rows expected in each raw table.
ROW_FLOORS = {
    "orders": 420,
    "order_items": 582,
    "order_payments": 420,
    "customers": 180,
    "products": 12,
    "marketing_qualified_leads": 4000,
    "closed_deals": 600,
}


@dataclass(frozen=True)
class EconomicsParams:
    completed_statuses: tuple[str, ...] = ("delivered", "returned")
    returned_status: str = "returned"
    fee_rates: Mapping[str, Decimal] = field(default_factory=lambda: dict(FEE_RATES))
    default_fee_rate: Decimal = DEFAULT_FEE_RATE
    reverse_logistics_multiplier: Decimal = Decimal("1.0")
    restocking_rate: Decimal = Decimal("0.10")
    monthly_spend: Mapping[str, Decimal] = field(default_factory=lambda: dict(MONTHLY_SPEND))
    csv_files: Mapping[str, str] = field(default_factory=lambda: dict(CSV_FILES))
    row_floors: Mapping[str, int] = field(default_factory=lambda: dict(ROW_FLOORS))
    revenue_tolerance: Decimal = Decimal("1")
    allocation_tolerance: Decimal = Decimal("0.05")
    cascade_tolerance: Decimal = Decimal("0.02")
    # A key with more rows than this is split over several tasks.
    rows_per_task: int = 1_000_000

    @classmethod
    def from_mapping(cls, settings: Mapping[str, Any]) -> EconomicsParams:
        """Read the settings-file layout: payment_fee_rates, return_cost, marketing_spend, ..."""
        params = cls()
        if "payment_fee_rates" in settings:
            rates = {k: Decimal(str(v)) for k, v in settings["payment_fee_rates"].items()}
            default = rates.pop("default", params.default_fee_rate)
            params = replace(params, fee_rates=rates, default_fee_rate=default)
        if "return_cost" in settings:
            cost = settings["return_cost"]
            params = replace(
                params,
                reverse_logistics_multiplier=Decimal(
                    str(cost.get("reverse_logistics_multiplier", params.reverse_logistics_multiplier))
                ),
                restocking_rate=Decimal(str(cost.get("restocking_fee_rate", params.restocking_rate))),
            )
        if "marketing_spend" in settings:
            spend = settings["marketing_spend"] or {}
            params = replace(params, monthly_spend={k: Decimal(str(v)) for k, v in spend.items()})
        if "staging_order_statuses" in settings:
            params = replace(params, completed_statuses=tuple(settings["staging_order_statuses"]))
        if "csv_files" in settings:
            params = replace(params, csv_files=dict(settings["csv_files"]))
        return params

    @classmethod
    def from_file(cls, path: str | Path) -> EconomicsParams:
        """Load a JSON settings file, or a YAML one where a YAML reader is installed."""
        text = Path(path).read_text(encoding="utf-8")
        if str(path).endswith(".json"):
            return cls.from_mapping(json.loads(text))
        try:
            import yaml
        except ImportError as exc:
            raise RuntimeError("reading YAML settings needs PyYAML; use JSON instead") from exc
        return cls.from_mapping(yaml.safe_load(text))


DEFAULT_PARAMS = EconomicsParams()
