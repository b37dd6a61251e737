"""Loads and reports composed from sources and operators."""
