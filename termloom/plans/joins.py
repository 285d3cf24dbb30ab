"""Joins on a key that may be badly skewed."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.plans.staging import stage

# A side is broadcast only when its measured content is below this.
BROADCAST_BYTES = 64 << 20
# Bookkeeping per row of a hashed relation, added to the content.
ROW_OVERHEAD = 64
# A key with more than one in HOT_FRACTION of all rows is hot. There are fewer than
# HOT_FRACTION such keys whatever the data.
HOT_FRACTION = 1000


def _column_bytes(field: T.StructField):
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0))
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))
    return F.lit(16)


def content_bytes(df: DataFrame) -> int:
    """Size of ``df`` measured on its rows, by one aggregation."""
    row = sum((_column_bytes(field) for field in df.schema), F.lit(ROW_OVERHEAD))
    return df.agg(F.coalesce(F.sum(row.cast("long")), F.lit(0)).alias("n")).first()["n"]


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return content_bytes(df) <= limit


def attach(
    big: DataFrame,
    small: DataFrame,
    key: str,
    how: str = "inner",
    broadcast_bytes: int = BROADCAST_BYTES,
    fits: bool = False,
) -> DataFrame:
    """Join ``big`` to ``small`` on one column, ``inner`` or ``left_semi``.

    ``small`` is measured first and broadcast if it fits, so ``big`` does not move; ``fits``
    says that something at least as large was measured and fits already. Otherwise
    ``big`` is split by key: the many ordinary keys go through a plain shuffle join, and the
    hot ones are salted over as many slots as bring a slot back to an ordinary key's size.
    """
    if how not in ("inner", "left_semi"):
        raise ValueError("how must be inner or left_semi")
    if how == "left_semi":
        small = small.select(key).distinct()
    big = big.filter(F.col(key).isNotNull())
    if fits or fits_broadcast(small, broadcast_bytes):
        return big.join(F.broadcast(small), key, how)

    # Written, so that a computed ``big`` is evaluated once for both uses.
    counts = stage(big.groupBy(key).agg(F.count(F.lit(1)).alias("n")), "key-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    # Fewer than HOT_FRACTION rows by the definition of hot.
    hot = counts.filter(F.col("n") * HOT_FRACTION > total).collect()
    if not hot:
        return big.join(small, key, how)
    is_hot = F.col(key).isin([row[key] for row in hot])
    plain = big.filter(~is_hot).join(small.filter(~is_hot), key, how)

    slots = math.ceil(max(row["n"] for row in hot) * HOT_FRACTION / total)
    # Rows made of the key alone are equal and stay together.
    rest = [c for c in big.columns if c != key] or [key]
    salted_big = big.filter(is_hot).withColumn(
        "_slot", F.pmod(F.xxhash64(*rest), F.lit(slots)).cast("int")
    )
    salted_small = small.filter(is_hot).withColumn(
        "_slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))
    )
    salted = salted_big.join(salted_small, [key, "_slot"], how).drop("_slot")
    return plain.unionByName(salted)
