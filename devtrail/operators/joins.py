"""Equi-joins on a single device or model key (E1-E6) and the size-checked
broadcast used for every per-model dimension.

Device-level joins (imei) shuffle both sides on the key; AQE's skew-join rule
splits a device that holds a third of a fact table into several tasks.
Model-level dimensions have one row per model and are broadcast -- but only
after their row count has been checked (``sized_broadcast``); above the
bound the join falls back to a shuffle join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..config import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS
from ..session import stage


def row_bytes(df: DataFrame):
    """Upper estimate of a row's in-memory (UnsafeRow) size: one 8-byte word
    for the null bits, one 8-byte slot per field, plus variable-length bytes."""
    fixed = F.lit(8 + 8 * len(df.columns))
    var = [F.coalesce(F.octet_length(F.col(c)), F.lit(0)) for c, t in df.dtypes if t in ("string", "binary")]
    out = fixed
    for v in var:
        out = out + v
    return out


def sized_broadcast(
    dim: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """Materialise ``dim`` once as a table in the shared checkpoint folder,
    measured by the job that writes it (row count and in-memory bytes; only two
    numbers reach the driver), and mark it for broadcast only if both are
    within bounds.  A larger ``dim`` is returned unmarked: the join then
    shuffles both sides (AQE may still broadcast from runtime sizes, or split
    skewed keys)."""
    seen = Observation()
    staged = stage(dim.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(dim)).alias("bytes")), "dim")
    found = seen.get  # empty if the optimizer found the table to be empty
    small = found.get("rows", 0) <= max_rows and (found.get("bytes") or 0) <= max_bytes
    return F.broadcast(staged) if small else staged


def prefixed(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    """Rename every column (except ``keep``) to ``prefix + name``."""
    return df.select([F.col(c).alias(c if c in keep else prefix + c) for c in df.columns])


def enrich(df: DataFrame, other: DataFrame, key: str = "imei", how: str = "inner") -> DataFrame:
    """E1 (inner) / E2 (``how='left'``): enrich a fact by device.  The fact's
    columns keep their places, the other side's follow."""
    return df.join(other, on=key, how=how).select(*df.columns, *(c for c in other.columns if c != key))


def enrich_left(df: DataFrame, other: DataFrame, key: str = "imei") -> DataFrame:
    """Keep every row of ``df``; unmatched rows get NULL columns (D3)."""
    return enrich(df, other, key, "left")


def full_outer_by(a: DataFrame, b: DataFrame, key: str = "model") -> DataFrame:
    """Full outer join of two per-key aggregates (key coalesced)."""
    return a.join(b, on=key, how="full")


def not_in(df: DataFrame, ref: DataFrame, key: str = "imei", ref_key: str | None = None) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``ref`` (duplicates on
    the left are kept), every column in its place.  The reference keys are
    reduced to a distinct set by a partial aggregation whose hash partitioning
    the anti join reuses."""
    keys = ref.select(F.col(ref_key or key).alias(key)).distinct()
    return df.join(keys, on=key, how="left_anti").select(*df.columns)


def only_not_in(
    df: DataFrame, ref: DataFrame, key: str = "imei", max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """E4 ahead of a reduction by the same key: the rows of ``df`` whose key does
    not occur in ``ref``, for a ``df`` of wide records of which few remain.

    First the keys alone are compared: distinct keys of both sides, an anti join
    of one-column tables.  The keys that remain are then met by the records, by
    a broadcast if they are few, so the others are neither shuffled nor sorted.
    A null key is in no ``ref`` and stays."""
    keys = not_in(df.select(key).distinct(), ref, key).select(F.col(key).alias("__key"))
    keys = sized_broadcast(keys, max_rows, max_bytes)
    return df.join(keys, F.col(key).eqNullSafe(F.col("__key")), "left_semi")


def lookup(
    df: DataFrame,
    dim: DataFrame,
    key: str = "model",
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """E5: left-join a per-``key`` dimension through ``sized_broadcast``;
    a missing key gives NULL (rendered ``NA``)."""
    return enrich_left(df, sized_broadcast(dim, max_rows, max_bytes), key)


def join_both_ends(
    edges: DataFrame,
    dim: DataFrame,
    from_key: str = "imei",
    to_key: str = "toimei",
    dim_key: str = "imei",
    edge_prefix: str = "xchg_",
    to_prefix: str = "to_",
    repeated: Sequence[str] = (),
    echoes: Sequence[str] = (),
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Role-playing double join -- every edge row joined to ``dim`` at its
    from-device and again at its to-device.  Output columns: ``dim`` as is,
    the edge columns with ``edge_prefix``, the to-side ``dim`` with ``to_prefix``.
    Both joins are inner (an edge needs both devices).

    The second join shuffles the from-side's wide rows, one for each edge.
    ``repeated`` names columns of ``dim`` that hold few combinations: a number
    travels for them, and a table of the combinations gives them back after the
    join -- if it is within the bounds of a broadcast, else they travel as they
    are.  ``echoes`` names columns that hold the dim's key or null: only which
    of the two travels."""
    e, types = prefixed(edges, edge_prefix), {**dict(dim.dtypes), **dict(prefixed(edges, edge_prefix).dtypes)}
    start, columns = edge_prefix + from_key, [*e.columns, *dim.columns]
    small = dim
    echoes = [c for c in echoes if types[c] == types[dim_key]]
    flags = {c: f"__has_{c}" for c in echoes}
    combined = [*repeated, *flags.values()]
    back = None
    if combined:
        small = dim.select("*", *(F.col(c).isNotNull().alias(f) for c, f in flags.items())).drop(*echoes)
        back = _numbered(small.select(*combined).distinct(), max_rows, max_bytes)
        if back is None:
            small = dim
        else:
            keys = back.select("__combination", *(F.col(c).alias(f"__key_{c}") for c in combined))
            same = [F.col(c).eqNullSafe(F.col(f"__key_{c}")) for c in combined]
            small = small.join(keys, reduce(lambda a, b: a & b, same)).drop(*combined, *(f"__key_{c}" for c in combined))
    from_side = e.join(small, F.col(start) == F.col(dim_key), "inner")
    to_side = prefixed(dim, to_prefix)
    joined = from_side.join(to_side, F.col(edge_prefix + to_key) == F.col(to_prefix + dim_key), "inner")
    if back is not None:
        joined = joined.join(back, "__combination").withColumns({c: F.when(F.col(f), F.col(dim_key)) for c, f in flags.items()})
    if types[start] == types[dim_key]:  # equal here: one of the two travels
        joined = joined.withColumn(start, F.col(dim_key))
    return joined.select(*columns, *to_side.columns)


def _numbered(combinations: DataFrame, max_rows: int, max_bytes: int) -> DataFrame | None:
    """The rows with a number each (``__combination``), marked for broadcast;
    None if they are too many to be sent to every task."""
    seen = Observation()
    staged = stage(combinations.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(combinations)).alias("bytes")), "combinations")
    found = seen.get
    if found.get("rows", 0) > max_rows or (found.get("bytes") or 0) > max_bytes:
        return None
    number = F.row_number().over(Window.orderBy(*(F.col(c).asc_nulls_first() for c in combinations.columns)))  # few: checked above
    return F.broadcast(staged.select("*", number.alias("__combination")))
