"""Expressions and types."""
