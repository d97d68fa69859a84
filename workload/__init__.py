"""The library's operators run over the given tables, and the same results as SQL."""
