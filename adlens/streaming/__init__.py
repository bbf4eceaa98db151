"""Incremental refresh of the daily table as new hourly files arrive."""
