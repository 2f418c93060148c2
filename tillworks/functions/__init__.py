"""Scalar functions: every one maps Columns to a Column, with no Python per row."""
