"""The one way this library joins a large table with a dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

_SPREAD = "__spread"


def join_dim(
    fact: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join ``fact`` with ``dim`` (one row per key) without trusting the size of ``dim``.

    No broadcast hint: Spark broadcasts ``dim`` only if its known size, or under adaptive
    execution its measured size, is below ``spark.sql.autoBroadcastJoinThreshold``. Beyond that
    it is a sort-merge join, and one key may then hold a third of ``fact``. Adaptive execution
    splits such a partition, but only if nothing downstream relies on the join's partitioning.
    The redundant hash key keeps later groupings on the join key from relying on it.
    """
    keys = [on] if isinstance(on, str) else list(on)
    for key, want, have in _differing(fact, dim, keys):
        dim = dim.withColumn(key, _same_type(key, want, have))
    spread = F.xxhash64(*keys)
    joined = fact.withColumn(_SPREAD, spread).join(
        dim.withColumn(_SPREAD, spread), [*keys, _SPREAD], how
    )
    return joined.drop(_SPREAD)


def _differing(
    fact: DataFrame, dim: DataFrame, keys: Sequence[str]
) -> list[tuple[str, T.DataType, T.DataType]]:
    """Keys whose type differs, with both types; whether null is allowed does not count."""
    both = [(k, fact.schema[k].dataType, dim.schema[k].dataType) for k in keys]
    return [(k, want, have) for k, want, have in both if want.simpleString() != have.simpleString()]


def _same_type(key: str, want: T.DataType, have: T.DataType) -> Column:
    """The dimension's key in the type of the fact's, as equal numbers of two types hash apart."""
    if isinstance(want, T.IntegralType) and isinstance(have, T.IntegralType):
        return F.col(key).try_cast(want)
    raise ValueError(f"key {key} is {want.simpleString()} on one side and {have.simpleString()} on the other")


def join_stats(fact: DataFrame, stats: DataFrame, by: Sequence[str]) -> DataFrame:
    """Put the row of its group beside each row of ``fact``; null is a group like any other."""
    group = "__group"
    right = stats.withColumn(group, F.struct(*by)).drop(*by)
    return join_dim(fact.withColumn(group, F.struct(*by)), right, group).drop(group)
