"""All queries of the library itself."""

from cairnwork.plans import curation_queries, matching_queries, record_queries, relational_queries, resolution_queries, review_queries, serving_queries, value_queries  # noqa: F401
from cairnwork.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
