"""Whole loads and the registered queries."""
