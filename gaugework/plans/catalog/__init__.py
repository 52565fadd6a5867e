"""All registered queries; importing the modules fills the registry."""

from gaugework.plans.catalog import causal, features, files, models, quality, rules, samples, summaries  # noqa: F401
from gaugework.plans.catalog.registry import QUERIES

__all__ = ["QUERIES"]
