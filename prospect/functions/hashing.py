"""Repeatable per-row randomness from a hash of the row key.

``sampleBy``/``randomSplit`` depend on partitioning: the same seed returned different rows
after a ``repartition``. A hash of ``seed:key`` gives the same answer on any layout, on a
retried task, and in DuckDB (``('0x' || substr(md5(k), 1, 8))::bigint``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_unit(key: Column | str, seed: int = 0) -> Column:
    """Uniform value in [0, 1): first 32 bits of md5("<seed>:<key>") / 2^32."""
    k = F.col(key) if isinstance(key, str) else key
    text = F.concat(F.lit(f"{seed}:"), k.cast("string"))
    bits = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return bits / F.lit(4294967296.0)
