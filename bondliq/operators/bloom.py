"""J1 for long bond lists: a Bloom filter of bounded size in front of the exact join.

A list of many million ids is too large to broadcast, and shuffling every quote only to
find out that its bond is not listed is the most expensive way to drop it. The ids are
therefore reduced to a blocked Bloom filter, a small table of at most ``BLOCKS`` rows of 512
bits, which is broadcast: a quote stays if the eight bits of its bond, all in one row, are
set. Quotes of listed bonds always stay; of the others a few in a hundred do, and the exact
join on the bond list, which comes later and on far fewer rows, removes those.

Built from ordinary functions: the filter is an aggregation (``bit_or``, combined map-side)
and the test a broadcast hash join on the block number with a condition on the bits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: rows of the filter, at most (64 bytes of bits each), and bits for each id
BLOCKS, BITS = 1 << 19, 16
LANES = 8


def _block(keys: Sequence[Column], blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), *keys), F.lit(blocks)).cast("int")


def _mark(keys: Sequence[Column], lane: int) -> Column:
    """One bit of a 64-bit lane."""
    place = F.shiftright(F.xxhash64(F.lit(2), *keys), 6 * lane).bitwiseAND(63).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def bloom_filter(ids: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """(block, m0 .. m7) of the ``rows`` ids."""
    blocks = max(1, min(BLOCKS, rows * BITS // (64 * LANES) + 1))
    own = [F.col(k) for k in keys]
    marks = [F.bit_or(_mark(own, i)).alias(f"_m{i}") for i in range(LANES)]
    out = ids.groupBy(_block(own, blocks).alias("_block")).agg(*marks)
    out.blocks = blocks
    return out


def maybe_in(df: DataFrame, keys: Sequence[str], found: DataFrame) -> DataFrame:
    """The rows of ``df`` whose keys the filter cannot rule out."""
    own = [F.col(k) for k in keys]
    cond = _block(own, found.blocks) == F.col("_block")
    for i in range(LANES):
        cond = cond & (F.col(f"_m{i}").bitwiseAND(_mark(own, i)) != 0)
    return df.join(F.broadcast(found), cond, "left_semi")  # BLOCKS rows at most


def maybe_listed(quotes: DataFrame, bonds: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Quotes whose bond may be in the list."""
    keys = [*also, "bond"]
    ids = bonds.select(*also, F.col("id").alias("bond"))
    n = ids.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    return maybe_in(quotes, keys, bloom_filter(ids, keys, n))
