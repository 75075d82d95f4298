"""Layered (bronze, silver, gold) processing of per-region content statistics on Spark."""
