"""Tabular cleaning, feature building and valuation models as Spark DataFrame operators."""
