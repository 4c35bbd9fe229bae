"""Queries by subject; every module has QUERIES and ORACLES by name."""

#: Modules of this package that hold queries.
MODULES = ("fact", "bi", "integrity", "features", "forecast", "scoring", "texts", "problems")
