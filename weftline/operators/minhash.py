"""MinHash signatures of integer sets, and the likeness of signatures."""

from __future__ import annotations

import random
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.scalars import HASH_PRIME, linear_hash


class HashParams(NamedTuple):
    a: int
    b: int
    prime: int = HASH_PRIME


def hash_params(k: int, seed: int) -> list[HashParams]:
    """``k`` linear hash functions, coefficients drawn from 1 to 2^31 - 2."""
    rng = random.Random(seed)
    return [
        HashParams(rng.randint(1, HASH_PRIME - 1), rng.randint(1, HASH_PRIME - 1))
        for _ in range(k)
    ]


def word_number(word: Column) -> Column:
    """A word as an integer from 1 to 2^28, from the first seven digits of its MD5."""
    return F.conv(F.substring(F.md5(word), 1, 7), 16, 10).cast("long") + F.lit(1)


def hash_rows(
    members: DataFrame, params: Sequence[HashParams], modulus: int, element: str = "element"
) -> DataFrame:
    """Each element's row number under every hash function, as columns ``h0``, ``h1``, ..."""
    x = F.col(element)
    return members.select(
        "*",
        *[linear_hash(x, p.a, p.b, modulus, p.prime).alias(f"h{i}") for i, p in enumerate(params)],
    )


def signatures(
    members: DataFrame,
    params: Sequence[HashParams],
    modulus: int,
    set_id: str = "set_id",
    element: str = "element",
) -> DataFrame:
    """One signature per set from the long form ``(set_id, element)``.

    Minima do not mind repeated elements, so nothing is made distinct first, and they combine
    before the shuffle: one row per set and task crosses it, however large the set. A set
    whose only element is NULL is empty; its signature is all ``prime``.
    """
    x = F.col(element)
    minima = [
        F.coalesce(F.min(linear_hash(x, p.a, p.b, modulus, p.prime)), F.lit(p.prime).cast("long"))
        for p in params
    ]
    found = members.groupBy(set_id).agg(*[m.alias(f"h{i}") for i, m in enumerate(minima)])
    return found.select(set_id, F.array(*[f"h{i}" for i in range(len(params))]).alias("signature"))


def membership_overlap(reference: Column, signature: Column) -> Column:
    """Share of the reference's entries found anywhere in the other; repeats each count."""
    hits = F.filter(reference, lambda e: F.array_contains(signature, e))
    return F.size(hits) / F.size(reference)


def positional_similarity(reference: Column, signature: Column) -> Column:
    """Share of positions that agree: the usual estimate of the Jaccard index."""
    same = F.zip_with(reference, signature, lambda x, y: (x == y).cast("int"))
    return F.aggregate(same, F.lit(0), lambda acc, s: acc + s) / F.size(reference)


def compare_with_reference(
    members: DataFrame,
    params: Sequence[HashParams],
    modulus: int,
    reference_id: int | None = None,
    set_id: str = "set_id",
    element: str = "element",
) -> DataFrame:
    """Overlap and similarity of one set's signature (default: lowest id) to every other's."""
    if reference_id is None:
        reference_id = members.agg(F.min(set_id)).first()[0]
    own = signatures(members.where(F.col(set_id) == reference_id), params, modulus, set_id, element)
    first = own.first()
    if first is None:
        raise ValueError(f"no set {reference_id}")
    # One signature of fixed length: it travels as a literal.
    ref = F.array(*[F.lit(h).cast("long") for h in first["signature"]])
    others = members.where(F.col(set_id) != reference_id)
    return signatures(others, params, modulus, set_id, element).select(
        F.col(set_id),
        membership_overlap(ref, F.col("signature")).alias("overlap"),
        positional_similarity(ref, F.col("signature")).alias("similarity"),
    )
