"""Named queries over the test tables, each with the SQL that states its result."""

from .base import ORACLES, QUERIES  # noqa: F401
from . import company_queries, graph_queries, record_queries, table_queries, text_queries, view_queries  # noqa: F401
