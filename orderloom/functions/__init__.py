"""Column expressions. Everything here is built from native functions."""
