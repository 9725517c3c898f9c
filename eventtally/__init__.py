"""Event metrics on Spark: parse events, total them per window, serve the totals."""
