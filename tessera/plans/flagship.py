"""Flagship job for the driver's smoke check: rules mined from conversations."""

from __future__ import annotations

from tessera.operators import rules as A
from tessera.plans.q_features_rules import conv_tx


def flagship_rules(spark, sf_dir: str, min_support: float = 0.05, min_confidence: float = 0.6,
                   min_lift: float = 1.2):
    _, rules = A.mine_rules(conv_tx(spark, sf_dir), min_support=min_support,
                            min_confidence=min_confidence, min_lift=min_lift)
    return A.format_rules(rules)
