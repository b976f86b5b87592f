"""Raw inputs, table lifecycle and the binding of the benchmark tables."""
