"""Training-data operators: dedup, scoring, filtering, formatting and tokenising of document tables."""
