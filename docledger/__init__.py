"""A PySpark engine that turns batches of business documents into queryable, auditable tables."""
