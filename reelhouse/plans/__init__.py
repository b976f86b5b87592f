"""Table builders: raw sources to warehouse, summaries and questions."""
