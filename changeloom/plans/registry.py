"""All queries over change data, with the SQL beside them."""

from __future__ import annotations

from changeloom.plans import change_queries, decision_queries, scalar_queries, stream_queries, topic_queries
from changeloom.plans.book import Query

BOOKS = [change_queries.BOOK, scalar_queries.BOOK, topic_queries.BOOK, decision_queries.BOOK, stream_queries.BOOK]

QUERIES: dict[str, Query] = {name: fn for book in BOOKS for name, fn in book.queries.items()}
ORACLES: dict[str, str] = {name: sql for book in BOOKS for name, sql in book.oracles.items()}
