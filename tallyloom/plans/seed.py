"""Dimension tables from a purchase history."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators import profile, state


@dataclass
class Seeded:
    suppliers: DataFrame
    payment_methods: DataFrame
    aliases: DataFrame
    statistics: DataFrame


def seed(history: DataFrame, categories: DataFrame, existing_aliases: DataFrame) -> Seeded:
    """Supplier, payment method and alias tables; aliases added by hand always stay."""
    folded = profile.fold_spellings(profile.spelling_profiles(history))
    return Seeded(
        profile.supplier_profiles(history).orderBy(F.lower("supplier"), "supplier"),
        profile.payment_counts(history),
        state.merge_aliases(existing_aliases, profile.detected_aliases(folded)),
        profile.seed_statistics(history, categories, existing_aliases),
    )
