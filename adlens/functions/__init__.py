"""Column-level helpers: ratios, dates, message text."""
