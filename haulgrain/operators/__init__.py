"""Relational operators: cleaning selects, matching, aggregates, KPIs, checks, findings."""
