"""Composite reports and the registry of runnable queries."""
