"""Scalar expressions, all built from Spark's own functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The letters counted as vowels, and the hash prime 2^31 - 1.
VOWELS = "aeiou"
HASH_PRIME = 2147483647

# Unicode white space plus the four ASCII separators that also split words.
WORD_GAP = r"(?U)[\s\x1c-\x1f]+"


def sqdist(p: Column, q: Column) -> Column:
    """Squared Euclidean distance of two ``array<double>`` columns."""
    squares = F.zip_with(p, q, lambda x, y: (x - y) * (x - y))
    return F.aggregate(squares, F.lit(0.0), lambda acc, s: acc + s)


def vector_literal(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(x)) for x in values])


def vowel_count(word: Column) -> Column:
    """Lower-case vowels in ``word``; upper-case letters and y do not count."""
    return F.length(word) - F.length(F.translate(word, VOWELS, ""))


def linear_hash(x: Column, a: int, b: int, modulus: int, prime: int = HASH_PRIME) -> Column:
    """``((a x + b) mod prime) mod modulus + 1`` in BIGINT; a, b and x stay below 2^31."""
    mixed = F.lit(a).cast("long") * x + F.lit(b).cast("long")
    return F.pmod(F.pmod(mixed, F.lit(prime).cast("long")), F.lit(modulus).cast("long")) + F.lit(1)


def polynomial(x: Column, coefficients: Sequence[float]) -> Column:
    """Value of the polynomial with ascending ``coefficients`` (Horner's scheme)."""
    value = F.lit(float(coefficients[-1]))
    for c in reversed(coefficients[:-1]):
        value = value * x + F.lit(float(c))
    return value


def relative_error(estimate: Column, actual: Column) -> Column:
    """Signed error over the actual value; NULL where that is 0."""
    return F.try_divide(estimate - actual, actual.cast("double"))
