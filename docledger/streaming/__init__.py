"""Incremental intake, and rates over run logs."""
