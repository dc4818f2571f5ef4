"""Training-data operators: text extraction, dedup, scoring, mixing, token files."""
