"""Registered queries of the core, with the equivalent SQL."""

from __future__ import annotations

from lexmill.plans import challenge_queries, court_queries, decision_queries, feed_queries, more_queries, practice_queries
from lexmill.plans.challenge_history import SQL as HISTORY_SQL
from lexmill.plans.challenge_history import p5_appended, p5_challengers, p5_found

QUERIES = {"p5_found": p5_found, "p5_appended": p5_appended, "p5_challengers": p5_challengers, **practice_queries.QUERIES, **decision_queries.QUERIES, **court_queries.QUERIES, **challenge_queries.QUERIES, **feed_queries.QUERIES, **more_queries.QUERIES}
SQL: dict[str, str] = {**HISTORY_SQL, **practice_queries.SQL, **decision_queries.SQL, **court_queries.SQL, **challenge_queries.SQL, **feed_queries.SQL, **more_queries.SQL}
