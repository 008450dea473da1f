"""Split and fold membership from a hash of the row key.

The hash depends on nothing but the key: a retried task, another partitioning or another run puts
every row in the same part, which a random draw per partition cannot promise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TEST_FOLD = -1


def hash_bucket(*key: str, seed: int | None = None) -> Column:
    """First 32 bits of the MD5 of the key, as a long. A null in the key raises an error."""
    parts = [
        F.coalesce(
            F.col(name).cast("string"), F.raise_error(F.lit(f"null in key column {name}")).cast("string")
        )
        for name in key
    ]
    if seed is not None:
        parts.insert(0, F.lit(str(seed)))
    digest = F.md5(parts[0] if len(parts) == 1 else F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def split_part(key: Sequence[str], weights: Sequence[int] = (7, 3), seed: int | None = None) -> Column:
    """Index of the part a row falls in, for integer ``weights``."""
    slot = hash_bucket(*key, seed=seed) % sum(weights)
    part = F.lit(len(weights) - 1)
    for i in reversed(range(len(weights) - 1)):
        part = F.when(slot < sum(weights[: i + 1]), i).otherwise(part)
    return part


def fold_of(
    key: Sequence[str],
    num_folds: int = 3,
    weights: Sequence[int] = (7, 3),
    seed: int | None = None,
) -> Column:
    """Cross-validation fold of a training row (first part), ``TEST_FOLD`` for any other row."""
    fold = F.floor(hash_bucket(*key, seed=seed) / sum(weights)) % num_folds
    return (
        F.when(split_part(key, weights, seed) == 0, fold).otherwise(TEST_FOLD).cast("int")
    )
