"""Reproducible pseudo-random order of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_order(keys: str | Sequence[str], seed: str | int | None = None) -> Column:
    """md5 of the key columns as hex text: an order that depends on the keys only.

    Sorting by it gives the same "random" order in every run and for every
    partitioning of the data; another ``seed`` gives another order.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    if seed is not None:
        parts.insert(0, F.lit(str(seed)))
    return F.md5(parts[0] if len(parts) == 1 else F.concat_ws("|", *parts))
