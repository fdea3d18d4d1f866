"""All registered queries (importing a module registers what it defines)."""

from kpiloom.registry import incidents, plans_and_answers, runs, tables, whole_answers  # noqa: F401
from kpiloom.registry.base import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
