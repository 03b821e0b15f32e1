"""A Bloom filter of one table's keys, to drop another table's rows before they are shuffled.

Made for a mapping far larger than the debits that look for a date in it: a
left join would shuffle all of the mapping, though most of its rows match
nothing.  The filter holds a key's three bits in one of ``blocks`` bitmaps of
4 KB, so it never exceeds ``blocks * 4`` KB (32 MB), whatever the data, and is
broadcast.  With 16 bits a key (16 million keys) about one in 150 other rows
passes; with many more keys more rows pass, and from some 10^8 on nearly all,
so it is an option.  The rows that pass are joined as ever: results never
depend on the filter.

The keys are hashed and made distinct before they are dealt to the blocks, so a
key that many rows have is one row there.  Null keys match nothing and are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bitmaps of the filter, a power of two; each has as many bits as Spark's bitmap functions give it.
BLOCKS = 1 << 13
BLOCK_BITS = 1 << 15
_HASH, _BLOCK, _BITS = "_bf_hash", "_bf_block", "_bf_bits"


def _hash(keys: tuple[str, ...]) -> Column:
    return F.xxhash64(*(F.col(k) for k in keys))


def _block(blocks: int) -> Column:
    return F.col(_HASH).bitwiseAND(F.lit(blocks - 1))


def _places() -> list[Column]:
    """The three bits of a hash: parts of it that the block's number does not use."""
    return [F.shiftrightunsigned(_HASH, low).bitwiseAND(F.lit(BLOCK_BITS - 1)) for low in (19, 34, 49)]


def _known(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    return df


def key_filter(df: DataFrame, *keys: str, blocks: int = BLOCKS) -> DataFrame:
    """The filter of the keys in ``df``: a row per block that has any, its number and its bitmap."""
    if blocks & (blocks - 1) or not 0 < blocks <= 1 << 19:
        raise ValueError("blocks must be a power of two, 2^19 at most")
    hashes = _known(df, keys).select(_hash(keys).alias(_HASH)).distinct()
    return (
        hashes.withColumn(_BLOCK, _block(blocks))
        .repartition(_BLOCK)
        .select(_BLOCK, F.explode(F.array(*_places())).alias("_bf_place"))
        .groupBy(_BLOCK)
        .agg(F.bitmap_construct_agg("_bf_place").alias(_BITS))
    )


def may_match(df: DataFrame, keys_of: DataFrame, *keys: str, blocks: int = BLOCKS) -> DataFrame:
    """The rows of ``df`` whose key may be in the filter ``keys_of`` (made with as many ``blocks``); all that are in it stay."""
    rows = _known(df, keys).withColumn(_HASH, _hash(keys)).withColumn(_BLOCK, _block(blocks))
    rows = rows.join(F.broadcast(keys_of), _BLOCK)
    for place in _places():
        byte = F.conv(F.hex(F.substring(_BITS, (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        rows = rows.where(F.getbit(byte, (place % 8).cast("int")) == 1)
    return rows.drop(_HASH, _BLOCK, _BITS)


def matching_mappings(mappings: DataFrame | None, rows: DataFrame, blocks: int = BLOCKS) -> DataFrame | None:
    """The mapping without (nearly all) rows whose account and number none of the ledger's ``rows`` has."""
    if mappings is None:
        return None
    wanted = rows.select("account_number", F.col("ledger_txn_no").alias("transaction_number"))
    keys = ("account_number", "transaction_number")
    return may_match(mappings, key_filter(wanted, *keys, blocks=blocks), *keys, blocks=blocks)
