"""DataFrame operators: spatial joins, dedup, merge, curation."""
