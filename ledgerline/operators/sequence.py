"""Arrival order of ledger rows.

The reference numbers rows with ``ROW_NUMBER() OVER ()`` in file order.  A
parallel reader has no file order by itself, so the ledger carries an explicit
unique ``seq``; ``sequence_from_files`` derives one from Parquet files, and
``dense_position`` turns any unique order into the dense 1..N row number.
Neither uses an unpartitioned window over the rows (that is one task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.config import DEFAULT_SPAN

# Row index bits reserved per file when packing (file ordinal, row index) into one LONG.
ROW_INDEX_BITS = 40
# Children of a node in the tree of buckets.
FAN_BITS = 21
FAN = 1 << FAN_BITS


def dense_position(df: DataFrame, order: str = "seq", out: str = "original_order", span: int = DEFAULT_SPAN) -> DataFrame:
    """Add ``out`` = 1-based position of each row in ``order`` over the whole table.

    Rows are grouped in buckets of ``span`` order units: a window numbers rows
    inside a bucket (at most ``span`` rows when ``order`` is unique).  A
    bucket's offset is a prefix sum over a tree: ``FAN`` neighbouring buckets
    have a parent, ``FAN`` neighbouring parents one of theirs, and so on up to
    the root, so however sparse the order is, no window holds more than ``FAN``
    nodes (or a bucket's rows).  The tables above the buckets shrink quickly
    where the order is dense.
    """
    with_b = df.withColumn("_pos_b", F.expr(f"`{order}` div {int(span)}"))
    counts = with_b.groupBy("_pos_b").agg(F.count(F.lit(1)).alias("_pos_n"))
    offsets = _sums_before(counts, order_bits(span)).withColumnRenamed("_pos_b", "_pos_ob")
    inside = Window.partitionBy("_pos_b").orderBy(order)
    numbered = with_b.withColumn("_pos_rn", F.row_number().over(inside))
    joined = numbered.join(offsets, F.col("_pos_b").eqNullSafe(F.col("_pos_ob")), "left")
    return joined.withColumn(out, (F.col("_pos_off") + F.col("_pos_rn")).cast("long")).drop(
        "_pos_b", "_pos_ob", "_pos_off", "_pos_rn"
    )


def order_bits(span: int, bits: int = 64) -> int:
    """Bits that the numbers of buckets of ``span`` units may have, of an order of ``bits`` bits."""
    return bits - (int(span).bit_length() - 1)


def _sums_before(counts: DataFrame, bits: int) -> DataFrame:
    """``_pos_off``: the sum of ``_pos_n`` of all nodes before each node ``_pos_b``, whose numbers have ``bits`` bits."""
    nodes = counts.withColumn("_pos_p", F.expr(f"_pos_b div {FAN}"))
    before = Window.partitionBy("_pos_p").orderBy("_pos_b").rowsBetween(Window.unboundedPreceding, -1)
    own = nodes.withColumn("_pos_in", F.coalesce(F.sum("_pos_n").over(before), F.lit(0)))
    if bits <= FAN_BITS:  # all have the same parent
        return own.select("_pos_b", F.col("_pos_in").alias("_pos_off"))
    parents = nodes.groupBy(F.col("_pos_p").alias("_pos_b")).agg(F.sum("_pos_n").alias("_pos_n"))
    above = _sums_before(parents, bits - FAN_BITS).select(F.col("_pos_b").alias("_pos_up"), "_pos_off")
    return own.join(above, F.col("_pos_p").eqNullSafe(F.col("_pos_up")), "left").select(
        "_pos_b", (F.col("_pos_off") + F.col("_pos_in")).alias("_pos_off")
    )


def positional_chunks(df: DataFrame, chunk_size: int, order: str = "seq", span: int = DEFAULT_SPAN) -> DataFrame:
    """Label every row with the chunk a positional slice of ``chunk_size`` rows puts it in.

    Adds ``original_order`` and ``chunk`` (0-based).  A single slice is then a
    ``where(chunk == i)``; the whole table stays one distributed job.
    """
    pos = dense_position(df, order, "original_order", span)
    return pos.withColumn("chunk", F.expr(f"(original_order - 1) div {int(chunk_size)}"))


def sequence_from_files(df: DataFrame, out: str = "seq") -> DataFrame:
    """Add ``out``: a unique arrival order following file order (files by path).

    ``df`` must be read straight from files (it uses the hidden ``_metadata``
    column).  Parquet: ``seq = file_ordinal << 40 | row_index``.  Other
    formats have no row index, so rows are numbered inside each file split
    (``monotonically_increasing_id`` runs in read order within a task) and the
    splits, ordered by (path, block start), get prefix-sum offsets; ``seq`` is
    then the dense position in file order.  The split and file tables hold one
    row per split/file.
    """
    meta_fields = df.select("_metadata").schema["_metadata"].dataType.fieldNames()
    if "row_index" in meta_fields:
        return _sequence_from_row_index(df, out)
    return _sequence_from_splits(df, out)


def _sequence_from_row_index(df: DataFrame, out: str) -> DataFrame:
    meta = df.select("*", F.col("_metadata.file_path").alias("_sf_path"), F.col("_metadata.row_index").alias("_sf_row"))
    files = meta.select("_sf_path").distinct()
    ranked = files.select(
        F.col("_sf_path").alias("_sf_p"), (F.row_number().over(Window.orderBy("_sf_path")) - 1).alias("_sf_ord")
    )
    joined = meta.join(ranked, F.col("_sf_path") == F.col("_sf_p"), "left")
    fits = (F.col("_sf_ord") < 1 << (63 - ROW_INDEX_BITS)) & (F.col("_sf_row") < 1 << ROW_INDEX_BITS)
    packed = F.when(fits, F.shiftleft(F.col("_sf_ord").cast("long"), ROW_INDEX_BITS) + F.col("_sf_row")).otherwise(
        F.raise_error(F.lit("more files, or rows in a file, than a packed sequence number holds")).cast("long")
    )
    return joined.withColumn(out, packed).drop("_sf_path", "_sf_row", "_sf_p", "_sf_ord")


def _sequence_from_splits(df: DataFrame, out: str) -> DataFrame:
    meta = df.select(
        "*",
        F.col("_metadata.file_path").alias("_sf_path"),
        F.col("_metadata.file_block_start").alias("_sf_block"),
        F.monotonically_increasing_id().alias("_sf_id"),
    )
    splits = meta.groupBy("_sf_path", "_sf_block").agg(
        F.min("_sf_id").alias("_sf_first"), F.count(F.lit(1)).alias("_sf_n")
    )
    earlier = Window.orderBy("_sf_path", "_sf_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select(
        F.col("_sf_path").alias("_sf_p"),
        F.col("_sf_block").alias("_sf_b"),
        "_sf_first",
        F.coalesce(F.sum("_sf_n").over(earlier), F.lit(0)).alias("_sf_off"),
    )
    cond = (F.col("_sf_path") == F.col("_sf_p")) & (F.col("_sf_block") == F.col("_sf_b"))
    joined = meta.join(offsets, cond, "left")
    position = F.col("_sf_off") + (F.col("_sf_id") - F.col("_sf_first")) + F.lit(1)
    return joined.withColumn(out, position.cast("long")).drop(
        "_sf_path", "_sf_block", "_sf_id", "_sf_p", "_sf_b", "_sf_first", "_sf_off"
    )
