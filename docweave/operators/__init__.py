"""Operators of the document compiler."""
