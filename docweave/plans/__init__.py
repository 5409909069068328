"""Compiling mappings, and the registered queries."""
