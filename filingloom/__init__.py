"""Disclosure-filing analytics on Spark: amendments, entity resolution, marts and checks."""
