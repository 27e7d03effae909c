"""Reusable DataFrame operators that the plans are built from."""
