"""The operators applied to the given test tables, with equivalent SQL."""
