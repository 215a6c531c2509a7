"""Binds the package to the driver's tables: adapter, registered queries, oracle SQL."""
