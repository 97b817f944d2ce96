"""Seeded hash in integer arithmetic that any SQL engine can repeat.

Sampling, folds and shuffles order rows by this value, so they are the same on
every run, after every retry, and on every engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Modulus and multipliers of the two mixing steps. Every product stays below 2^63.
KEY_MODULUS = 2147483647
FIRST_MULTIPLIER = 2654435761
SEED_MULTIPLIER = 40503
SECOND_MULTIPLIER = 1103515245
SPACE = 4294967296


def hash32(key: Column, seed: int = 42) -> Column:
    """Uniform value in [0, 2^32) for a long key."""
    x = (F.pmod(key.cast("long"), F.lit(KEY_MODULUS)) * F.lit(FIRST_MULTIPLIER) + F.lit(seed * SEED_MULTIPLIER)) % F.lit(SPACE)
    return (x.bitwiseXOR(F.shiftright(x, 16)) * F.lit(SECOND_MULTIPLIER)) % F.lit(SPACE)


def unit_hash(key: Column, seed: int = 42) -> Column:
    """The hash as a double in [0, 1)."""
    return hash32(key, seed) / F.lit(float(SPACE))


def hash32_sql(key: str, seed: int = 42) -> str:
    """The same value as SQL text."""
    x = f"(((({key}) % {KEY_MODULUS}) * {FIRST_MULTIPLIER} + {seed * SEED_MULTIPLIER}) % {SPACE})"
    return f"((xor({x}, {x} >> 16) * {SECOND_MULTIPLIER}) % {SPACE})"
