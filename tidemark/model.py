"""The data model: four DataFrames (see :mod:`tidemark.schema`)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Tables:
    customers: DataFrame
    subscriptions: DataFrame
    payments: DataFrame
    costs: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {
            "customers": self.customers,
            "subscriptions": self.subscriptions,
            "payments": self.payments,
            "costs": self.costs,
        }
