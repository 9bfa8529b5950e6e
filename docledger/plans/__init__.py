"""Whole batches, and the registered queries."""
