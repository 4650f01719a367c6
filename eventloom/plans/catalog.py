"""All registered queries: importing the modules fills the registry."""

from eventloom.plans import queries_actors, queries_articles, queries_events, queries_learning, queries_sources, queries_text  # noqa: F401
from eventloom.plans.registry import FLAGSHIP, ORACLES, QUERIES

__all__ = ["FLAGSHIP", "ORACLES", "QUERIES"]
