"""Join helper: broadcast only behind a byte bound, with a shuffle join beyond it.

The caller gives a proven upper bound on the small side's rows, computed from
cheap inputs (e.g. channel table <= 20 x genres + 200 rows, from an items-only
count), and the bytes of a row (a vector counts 8 bytes a number).  Beyond the
limit the frame is returned as it is and Spark plans a shuffle join (AQE may
still convert it at run time from the measured size, and splits skewed
partitions).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_BYTES = 256 << 20
ID_ROW_BYTES = 64  # a few ids and short keys
PIECE_ROWS = 100_000  # rows of a list that meet a salt of its users in one place


def row_bytes(numbers: int = 0, chars: int = 0) -> int:
    """Bytes of a row with a vector of ``numbers`` doubles and ``chars`` characters of text, beside its ids."""
    return ID_ROW_BYTES + 8 * numbers + 4 * chars


def broadcast_within(df: DataFrame, bound_rows: int, per_row: int = ID_ROW_BYTES, max_bytes: int | None = None) -> DataFrame:
    """Broadcast ``df`` when ``bound_rows`` x ``per_row`` bytes is within the limit; ``df`` is never evaluated for it."""
    return F.broadcast(df) if bound_rows * per_row <= (MAX_BROADCAST_BYTES if max_bytes is None else max_bytes) else df


def meet_lists(many: DataFrame, lists: DataFrame, key: str, spread: str, place: str, list_rows: Column, bound_rows: int,
               per_row: int = ID_ROW_BYTES, piece_rows: int | None = None, salts: int | None = None) -> DataFrame:
    """``many`` joined with the rows of its key's list, also when a key holds every row of ``many``.

    ``lists`` (at most ``bound_rows`` rows) is broadcast within the byte limit.  Beyond it a plain shuffle would bring all
    rows of a key to one task, so the key becomes a grid: a list is dealt into pieces by ``place``, the rows of ``many``
    into ``salts`` (the session's shuffle partitions unless given) by ``spread``; every list row goes to each salt and
    every row of ``many`` to each piece of its list.  ``list_rows``: the most rows a list may have, from the key alone.
    A (key, salt, piece) then holds a bounded list and a share of the rows.  Null keys meet nothing.
    """
    if bound_rows * per_row <= MAX_BROADCAST_BYTES:
        return many.join(F.broadcast(lists), key)
    salts = salts or int(many.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = F.greatest(F.ceil(list_rows / F.lit(piece_rows or PIECE_ROWS)).cast("int"), F.lit(1))
    dealt = many.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    dealt = dealt.withColumn("_piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
    spread_lists = lists.withColumn("_piece", F.pmod(F.xxhash64(place), pieces).cast("int"))
    spread_lists = spread_lists.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(spread_lists, [key, "_salt", "_piece"]).drop("_salt", "_piece")
