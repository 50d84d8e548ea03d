"""Registered queries: one callable (star -> DataFrame) per operation."""
