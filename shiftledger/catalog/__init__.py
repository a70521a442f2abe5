"""The operators as named queries over the benchmark tables, with equivalent SQL."""
