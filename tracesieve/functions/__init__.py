"""Scalar functions: Column -> Column, all built-in expressions."""
