"""Null-safe joins on named keys. No broadcast hint is given anywhere in the library:
Spark broadcasts a side only when its measured size is under
`spark.sql.autoBroadcastJoinThreshold`, and otherwise sort-merges with skew splitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import all_of


def join_keys(
    left: DataFrame, right: DataFrame, keys: list[str] | dict[str, str], how: str = "left",
    null_safe: bool = True, extra: Column | None = None,
) -> DataFrame:
    """Join on equally named (or mapped) keys; the key columns appear once, under their left name.

    In a full join the keys of right-only rows are taken from the right. `null_safe` matches
    null keys with null keys.
    """
    pairs = keys if isinstance(keys, dict) else {k: k for k in keys}
    renamed = {r: f"__r_{r}" for r in pairs.values()}
    other = right.withColumnsRenamed(renamed)
    condition = all_of(
        F.col(l).eqNullSafe(F.col(renamed[r])) if null_safe else F.col(l) == F.col(renamed[r])
        for l, r in pairs.items()
    )
    if extra is not None:
        condition = condition & extra
    joined = left.join(other, condition, how)
    if how in ("left_semi", "left_anti", "semi", "anti"):
        return joined
    if how in ("full", "outer", "full_outer", "right"):
        joined = joined.withColumns({l: F.coalesce(F.col(l), F.col(renamed[r])) for l, r in pairs.items()})
    return joined.drop(*renamed.values())
