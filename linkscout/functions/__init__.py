"""Column-level helpers: geometry, text, dates and colour rules."""
