"""Every operator as a query over the given tables, each with the SQL that must give the same rows."""

from charlake.checks import (  # noqa: F401  (importing registers the queries)
    aggregate_queries,
    attribute_queries,
    feedback_queries,
    file_queries,
    join_queries,
    row_queries,
    table_queries,
    transcript_queries,
)
from charlake.checks.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
