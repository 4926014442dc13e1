"""Column expressions, Arrow/NumPy kernels and the SQL surface."""
