"""Readers."""

from lienspark.sources.lake import input_present, read_loans, read_rates, read_staging
from lienspark.sources.rates import normalise_rates
from lienspark.sources.register import read_register, read_register_inferred
from lienspark.sources.seeds import builtin_seeds, read_seeds

__all__ = [
    "builtin_seeds",
    "input_present",
    "normalise_rates",
    "read_loans",
    "read_rates",
    "read_register",
    "read_register_inferred",
    "read_seeds",
    "read_staging",
]
