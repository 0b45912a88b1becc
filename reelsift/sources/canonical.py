"""Canonical recommendation tables derived from the driver's TPC-H-like tables.

ratings(user_id, item_id, rating, ts)  one row per (user, item)
items(item_id, title, genres)           '%101' part keys dropped (rated items with no item row)
links(item_id, imdb_id, tmdb_id)
item_emb(item_id, emb ARRAY<FLOAT>)

Only the columns each view needs are read, so parquet scans get a pruned
ReadSchema.  The ratings de-duplication is a hash aggregate (max of a packed
number) rather than a window, so it combines map-side and a hot (user, item)
key never lands in one sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the canonical views (shared with the SQL oracle).
ITEM_NO_YEAR_MOD = 97  # titles without a year
ITEM_MISSING_MOD = 101  # rated items without an item row
LINK_MISSING_MOD = 53  # items without a links row
EPOCH_DAY_SECONDS = 86400
# Bits of the packed number below the day (15 bits): a key that does not fit is an error, not another result.
ORDER_BITS, LINE_BITS, STEP_BITS = 40, 4, 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    day = epoch_day(F.col("l_shipdate"), li.schema["l_shipdate"].dataType)
    steps = F.ceil(F.col("l_quantity") / 5).cast("bigint")  # the rating in half stars
    # (day, order, line) and the rating in one long: the latest row is a plain maximum, which hashes and combines
    # map-side inside generated code (a struct's maximum would sort)
    packed, fits = F.lit(0).cast("bigint"), F.lit(True)
    for part, bits in ((day, 63 - ORDER_BITS - LINE_BITS - STEP_BITS), (F.col("l_orderkey"), ORDER_BITS), (F.col("l_linenumber").cast("bigint"), LINE_BITS), (steps, STEP_BITS)):
        packed = F.shiftleft(packed, bits).bitwiseOR(part)
        fits = fits & part.between(0, (1 << bits) - 1)
    packed = F.when(fits | fits.isNull(), packed).otherwise(F.raise_error(F.lit("a day, order key, line number or quantity is outside the packed range")).cast("bigint"))
    latest = li.join(o, li.l_orderkey == o.o_orderkey).groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id")).agg(F.max(packed).alias("m"))
    return latest.select(
        "user_id",
        "item_id",
        (F.col("m").bitwiseAND((1 << STEP_BITS) - 1) * 0.5).alias("rating"),
        (F.shiftright("m", ORDER_BITS + LINE_BITS + STEP_BITS) * EPOCH_DAY_SECONDS).alias("ts"),
    )


def epoch_day(ts, data_type) -> F.Column:
    """Whole days since 1970-01-01 of a parquet timestamp, independent of the session time zone.

    The files hold time-zone-less microseconds: read as TIMESTAMP_NTZ the date
    cast is zone-free; if a session reads them as a zoned TIMESTAMP, the raw
    microseconds are used instead of a zone-shifted date.
    """
    if isinstance(data_type, T.TimestampNTZType):
        return F.unix_date(ts.cast("date")).cast("bigint")
    if isinstance(data_type, T.TimestampType):
        return F.floor(F.unix_micros(ts) / F.lit(86_400_000_000)).cast("bigint")
    return F.unix_date(ts.cast("date")).cast("bigint")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size")
    sp = F.instr("p_name", " ") - 1
    first = F.substring("p_name", F.lit(1), sp)
    rest = F.expr("substr(p_name, instr(p_name, ' ') + 1)")
    kind = F.col("p_partkey") % 4
    genres = (
        F.when(kind == 0, F.col("p_type"))
        .when(kind == 1, F.concat(F.col("p_type"), F.lit("|"), first))
        .otherwise(F.concat(F.col("p_type"), F.lit("|"), first, F.lit("|"), rest))
    )
    title = F.when(F.col("p_partkey") % ITEM_NO_YEAR_MOD == 0, F.col("p_name")).otherwise(
        F.concat(F.col("p_name"), F.lit(" ("), (F.lit(1970) + F.col("p_size")).cast("string"), F.lit(")"))
    )
    return p.where(F.col("p_partkey") % ITEM_MISSING_MOD != 0).select(
        F.col("p_partkey").alias("item_id"), title.alias("title"), genres.alias("genres")
    )


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey")
    return p.where(F.col("p_partkey") % LINK_MISSING_MOD != 0).select(
        F.col("p_partkey").alias("item_id"),
        F.lpad(F.col("p_partkey").cast("string"), 7, "0").alias("imdb_id"),
        (F.col("p_partkey") * 7).cast("string").alias("tmdb_id"),
    )


def item_emb(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return e.select(F.col("vec_id").alias("item_id"), F.col("embedding").cast("array<float>").alias("emb"))
