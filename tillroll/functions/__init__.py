"""Column expressions and global-order helpers shared by the operators."""
