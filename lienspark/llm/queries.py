"""Import of every module that registers queries."""

from __future__ import annotations

from lienspark.llm import chat, decontaminate, language, line_rules, lm, mixing, near_dup, negatives, pii, quality, repair, suffix_array, suffix_automaton  # noqa: F401
from lienspark.llm.registry import ORACLES, QUERIES  # noqa: F401
