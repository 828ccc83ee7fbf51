"""Operators the gold and silver layers compose: cleaning, quality, ranking, quantiles,
hot-key splitting."""

from laminar.operators import cleaning, quality, quantiles, ranking, skew

__all__ = ["cleaning", "quality", "quantiles", "ranking", "skew"]
