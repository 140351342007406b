"""Table operators: one module per layer of the warehouse."""
