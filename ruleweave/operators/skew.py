"""Skew-safe lookup join: a large table probing a table with one row per key.

When the lookup side is small (row count checked) it is broadcast and skew
cannot arise.  Otherwise a key holding a large share of the probe rows would
land in one shuffle partition, so hot keys are split:

1. count probe rows per key (partial aggregation, so hot keys cost one row
   per map task);
2. keys above ``chunk_rows`` get ``ceil(count / chunk_rows)`` salts; this
   hot-key table has at most ``probe_rows / chunk_rows`` rows, a bound fixed
   by construction, and is broadcast;
3. probe rows of a hot key spread over its salts by a running number; the
   lookup row of a hot key is replicated once per salt; rows with a null key
   match nothing and spread over ``NULL_SALTS``;
4. equi-join on ``(key, salt)``: every partition holds at most about
   ``chunk_rows`` probe rows per key.

Replication adds at most ``probe_rows / chunk_rows`` lookup rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ruleweave.operators.sizing import DEFAULT_BROADCAST_ROWS, is_small, materialize

DEFAULT_CHUNK_ROWS = 1_000_000
NULL_SALTS = 4096


def hot_keys(probe: DataFrame, columns: Sequence[str], chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """``<column, _hk, _ns>``: keys of text columns with more than ``chunk_rows`` rows and their salts.

    One pass over ``probe`` counts all columns; the result has at most
    ``rows x columns / chunk_rows`` rows and is written to the shared folder.
    """
    items = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("_hk")) for c in columns])
    return materialize(
        probe.select(F.inline(items)).filter(F.col("_hk").isNotNull())
        .groupBy("column", "_hk").agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > chunk_rows)
        .select("column", "_hk", F.ceil(F.col("_n") / F.lit(chunk_rows)).cast("int").alias("_ns"))
    )[0]


def lookup_join(probe: DataFrame, lookup: DataFrame, probe_key: str, lookup_key: str, how: str = "inner",
                chunk_rows: int = DEFAULT_CHUNK_ROWS, broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                lookup_small: bool | None = None, hot: DataFrame | None = None) -> DataFrame:
    """``probe ⋈ lookup`` on ``probe[probe_key] = lookup[lookup_key]`` (``inner`` or ``left``).

    ``lookup`` must hold at most one row per key.  Output columns: all probe
    columns, then the lookup columns except ``lookup_key``.  ``hot`` may give the hot
    keys ``<_hk, _ns>`` of this column (from :func:`hot_keys`); then the probe is read
    by the join alone.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    extra = [c for c in lookup.columns if c != lookup_key]
    clash = set(extra) & set(probe.columns)
    if clash:
        raise ValueError(f"lookup columns also in the probe side: {sorted(clash)}")
    small = is_small(lookup, broadcast_rows) if lookup_small is None else lookup_small
    if small:
        side = F.broadcast(lookup.withColumnRenamed(lookup_key, "_lk"))
        out = probe.join(side, F.col(probe_key) == F.col("_lk"), how)
        return out.select(*probe.columns, *extra)

    hot, n_hot = (hot, hot.count()) if hot is not None else materialize(
        probe.filter(F.col(probe_key).isNotNull())
        .groupBy(F.col(probe_key).alias("_hk")).agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > chunk_rows)
        .select("_hk", F.ceil(F.col("_n") / F.lit(chunk_rows)).cast("int").alias("_ns"))
    )
    hot = F.broadcast(hot) if n_hot <= broadcast_rows else hot
    p = probe.join(hot, F.col(probe_key) == F.col("_hk"), "left")
    # a running number spreads equal rows too; null keys match nothing and are spread over many salts
    salts = F.when(F.col(probe_key).isNull(), F.lit(NULL_SALTS)).otherwise(F.coalesce(F.col("_ns"), F.lit(1)))
    p = p.select(*probe.columns, F.pmod(F.monotonically_increasing_id(), salts.cast("long")).cast("int").alias("_salt"))
    lk = lookup.join(hot, F.col(lookup_key) == F.col("_hk"), "left")
    lk = lk.select(
        F.col(lookup_key).alias("_lk"), *extra,
        F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_ns"), F.lit(1)) - 1)).alias("_lsalt"),
    )
    out = p.join(lk, (F.col(probe_key) == F.col("_lk")) & (F.col("_salt") == F.col("_lsalt")), how)
    return out.select(*probe.columns, *extra)


def lookup_join_many(probe: DataFrame, lookup: DataFrame, keys: Sequence[str], **kw) -> DataFrame:
    """:func:`lookup_join` on several key columns (null-safe), via one packed key."""
    packed_p = probe.withColumn("_pk", F.struct(*[F.col(k) for k in keys]))
    packed_l = lookup.select(F.struct(*[F.col(k) for k in keys]).alias("_lkey"),
                             *[c for c in lookup.columns if c not in keys])
    out = lookup_join(packed_p, packed_l, "_pk", "_lkey", **kw)
    return out.drop("_pk")
