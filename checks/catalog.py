"""All registered check queries."""

from checks import q_classify, q_flows, q_frontier, q_nested, q_pages, q_reports, q_sources, q_state  # noqa: F401
from checks.base import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
