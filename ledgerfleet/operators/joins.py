"""Joins of a large per-row relation with a small per-target relation.

Joining on ``target_id`` alone sends every row of a hot target to one reduce
task.  AQE already broadcasts the small side when its runtime size is below
``spark.sql.adaptive.autoBroadcastJoinThreshold`` (a measured size, not a
guess); ``per_target_join`` adds a salt so that the sort-merge fallback spreads
a hot target over all tasks: by default there are as many salts as shuffle
partitions, so the share of a target in one task falls as the cluster grows.
The small side must have at most one row per key; it is replicated per salt,
which is cheap because it has one row per target.  Sides
with one row per *key* (as large as a table) are joined plainly instead:
AQE's skew join splits a hot key on the large side without copying them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def per_target_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "left",
                    salts: int | None = None, spread_by: list[str] | None = None) -> DataFrame:
    """``big.join(small, on, how)`` with the hot-key spread described above.

    ``spread_by`` names big-side columns that vary inside a target (default:
    all big-side columns not in ``on``) and decide a row's salt.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"per_target_join does not support {how!r}")
    salts = salts or int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = spread_by or [c for c in big.columns if c not in on]
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in spread]), F.lit(salts)) if spread else F.lit(0)
    b = big.withColumn("__salt", salt.cast("int"))
    s = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return b.join(s, [*on, "__salt"], how).drop("__salt")
