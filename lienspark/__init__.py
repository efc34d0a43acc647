"""Mortgage loan risk analytics as ordinary Spark DataFrame plans."""
