"""Reusable operators: fact-to-month aggregation (:mod:`.monthly`),
monthly-series steps (:mod:`.series`) and billing/integrity helpers
(:mod:`.facts`)."""
