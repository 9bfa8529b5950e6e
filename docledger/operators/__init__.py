"""Relational operators: intake, merge, reports, dashboard."""
