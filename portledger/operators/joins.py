"""Left join against a keyed side of unknown size.

A side is only broadcast after its size was measured. Beyond the bound the join shuffles, and keys
that hold a large share of the rows are taken out of the shuffle first: at most ``1 / HOT_SHARE`` keys
can each hold ``HOT_SHARE`` of the rows, so the part of the keyed side that is broadcast for them has
a fixed bound whatever the data size.
"""

from functools import reduce
from operator import add

from pyspark.sql import functions as F

from portledger.session import pinned

BROADCAST_BYTES = 64 << 20
BROADCAST_ROWS = 1_000_000
HOT_SHARE = 1 / 50_000
SALTS = 4096


def text_bytes(df, columns=None):
    """Column expression: rough size of a row's values as text."""
    sizes = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in columns or df.columns]
    return reduce(add, sizes)


def size_columns(df):
    """Aggregates ``rows`` and ``bytes`` of ``df``."""
    return [F.count("*").alias("rows"), F.coalesce(F.sum(text_bytes(df)), F.lit(0)).alias("bytes")]


def is_small(measured, max_bytes=None, max_rows=None):
    """Whether a measured side is small enough to copy to every executor."""
    rows = BROADCAST_ROWS if max_rows is None else max_rows
    size = BROADCAST_BYTES if max_bytes is None else max_bytes
    return measured["rows"] <= rows and measured["bytes"] <= size


def fits_broadcast(df, max_bytes=None, max_rows=None):
    return is_small(df.agg(*size_columns(df)).first(), max_bytes, max_rows)


def keyed_left_join(big, small, key, spread_by, small_fits=None):
    """Left join on column ``key``, which is unique in ``small``.

    ``spread_by`` names columns of ``big`` that vary within one key; they spread a hot key's rows.
    """
    if fits_broadcast(small) if small_fits is None else small_fits:
        return big.join(F.broadcast(small), key, "left")
    return _split_hot_keys(big, small, key, spread_by)


def _split_hot_keys(big, small, key, spread_by):
    values = [c for c in small.columns if c != key]
    # One narrow pass over the big side; the counts are kept because both steps below need them.
    counts = pinned(big.groupBy(key).agg(F.count("*").alias("_n")))
    floor = (counts.agg(F.sum("_n")).first()[0] or 0) * HOT_SHARE
    hot = counts.where(F.col("_n") >= floor).select(key)
    hot_values = small.join(F.broadcast(hot), key, "left_semi").select(
        key, F.struct(*values).alias("_hot")
    )
    hot_keys = hot.join(F.broadcast(hot_values), key, "left").withColumn("_is_hot", F.lit(True))

    # A hot row already has its values: it gets no shuffle key to match and a salt to spread by.
    is_hot = F.coalesce(F.col("_is_hot"), F.col(key).isNull())
    tagged = (
        big.join(F.broadcast(hot_keys), key, "left")
        .withColumn("_cold_key", F.when(~is_hot, F.col(key)))
        .withColumn(
            "_salt",
            F.when(is_hot, F.pmod(F.xxhash64(*spread_by), F.lit(SALTS))).otherwise(F.lit(0)),
        )
    )
    cold = small.select(
        F.col(key).alias("_cold_key"),
        F.lit(0).cast("bigint").alias("_salt"),
        F.struct(*values).alias("_cold"),
    )
    joined = tagged.join(cold, ["_cold_key", "_salt"], "left")
    picked = [F.coalesce(F.col("_hot")[v], F.col("_cold")[v]).alias(v) for v in values]
    return joined.select(*big.columns, *picked)
