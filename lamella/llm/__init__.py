"""Text operators: tokenising, packing, truncation. Nothing outside this package imports it."""
