"""Feature encoders (M0, M2-M8) on Spark ML transformers and native expressions."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import Bucketizer, CountVectorizerModel, MinMaxScaler, OneHotEncoder, QuantileDiscretizer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsift.functions import genre_pieces
from reelsift.operators.cumulative import running_totals
from reelsift.operators.item_features import item_rating_variance
from reelsift.operators.positions import BLOCK_ROWS, heavy_positions
from reelsift.plans import joins
from reelsift.session import written

QUANTILE_BUCKETS = 100  # fixed value: rating-count buckets
HEAD_LABELS = 10_000  # most frequent labels that travel to the rows; rarer ones meet them by a shuffle


def one_hot(df: DataFrame, col: str = "item_id", out: str = "one_hot") -> DataFrame:
    """M0 (+P15): one-hot vector of an integer id, last category kept."""
    num = f"{col}_num"
    d = df.withColumn(num, F.col(col).cast("int"))
    enc = OneHotEncoder(inputCols=[num], outputCols=[out], dropLast=False)
    return enc.fit(d).transform(d)


def genre_indexer(items: DataFrame):
    """M2: StringIndexer over exploded genres (frequency desc, ties by name)."""
    g = items.select("item_id", F.explode(genre_pieces("genres")).alias("genre"))
    model = StringIndexer(inputCol="genre", outputCol="genre_index", stringOrderType="frequencyDesc").fit(g)
    return model, g


def multi_hot(items: DataFrame) -> DataFrame:
    """M3 (+A8, A9, M4): sparse multi-hot genre vector per item; a blank genre string is a genre of its own, an item
    with a null one has no row.

    The indexer's labels are the vocabulary of a ``CountVectorizerModel``, which builds the sparse vectors in place: no
    shuffle, nothing of the vocabulary's size per item.
    Output: item_id, genre_indexes (sorted), index_size, vector.
    """
    model, _ = genre_indexer(items)
    vectors = CountVectorizerModel.from_vocabulary(list(model.labels), inputCol="_pieces", outputCol="vector", binary=True)
    listed = items.where(F.col("genres").isNotNull()).select("item_id", genre_pieces("genres").alias("_pieces")).where(F.size("_pieces") > 0)
    out = vectors.transform(listed)
    return out.select("item_id", vector_active("vector").alias("genre_indexes"), vector_size("vector").alias("index_size"), "vector")


def frequency_index(df: DataFrame, col: str, out: str = "label_index", rows_per_partition: int = BLOCK_ROWS) -> DataFrame:
    """M2 for vocabularies the driver cannot hold: (col, n, out), values by frequency (descending; ties by value) from 0.

    The order of ``StringIndexer(frequencyDesc)``, but as a table: values are counted with a map-side partial, the
    counts are range-partitioned in that order and numbered inside each partition, and a partition's numbers start after
    the rows of those before it.  No label reaches the driver.  Nulls have no row; an empty table gives an empty index.
    """
    counts = written(df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n")))
    ordered = counts.withColumn("_all", F.lit(0)).withColumn("_least", -F.col("n"))
    return heavy_positions(ordered, "_all", ["_least", col], counts.count(), rows_per_partition).select(col, "n", F.col("pos").alias(out))


def with_index(df: DataFrame, col: str, index: DataFrame, out: str = "label_index", head_labels: int = HEAD_LABELS) -> DataFrame:
    """``df`` with ``out`` joined back from a ``frequency_index`` of ``col`` (null where the value is null or not in it).

    The index is in order of frequency, so its head holds every hot value: those (at most ``head_labels``, fewer where
    long labels would pass the byte limit) are broadcast, and only rows of rarer values are shuffled.  A value of the tail
    has at most rows / head labels rows, so no shuffle key is hot however skewed the column is.
    """
    chars, labels = index.agg(F.coalesce(F.max(F.length(F.col(col).cast("string"))), F.lit(0)), F.count(F.lit(1))).first()
    head_labels = min(head_labels, joins.MAX_BROADCAST_BYTES // joins.row_bytes(chars=chars))
    number = index.select(F.col(col).alias("_label"), F.col(out).alias("_at"))
    near = df.join(F.broadcast(number.where(F.col("_at") < head_labels)), F.col(col) == F.col("_label"), "left").drop("_label")
    if labels <= head_labels:
        return near.withColumnRenamed("_at", out)
    rare = number.where(F.col("_at") >= head_labels).withColumnRenamed("_at", "_far")
    near = written(near)  # two readers; null values have no label and stay with the head
    done = F.col("_at").isNotNull() | F.col(col).isNull()
    rare = number.where(F.col("_at") >= head_labels)
    far = near.where(~done).drop("_at").join(rare, F.col(col) == F.col("_label"), "left").drop("_label")
    return near.where(done).unionByName(far).withColumnRenamed("_at", out)


def multi_hot_spread(items: DataFrame, head_labels: int = HEAD_LABELS) -> DataFrame:
    """M3 for large vocabularies: (item_id, genre_indexes sorted, index_size), the rows of ``multi_hot`` without its
    vectors, from an index that stays a table.  Rows with the same item_id are one item."""
    pieces = items.where(F.col("genres").isNotNull()).select("item_id", F.explode(genre_pieces("genres")).alias("genre"))
    index = written(frequency_index(pieces, "genre"))
    size = index.count()
    indexed = with_index(pieces, "genre", index, "label_index", head_labels)
    hot = indexed.groupBy("item_id").agg(F.array_sort(F.collect_set("label_index")).alias("genre_indexes"))
    return hot.select("item_id", "genre_indexes", F.lit(size).cast("bigint").alias("index_size"))


def vector_active(vec_col: str) -> F.Column:
    """Indexes of the entries of a sparse ML vector column (as OneHotEncoder and CountVectorizerModel make them)."""
    return F.unwrap_udt(vec_col)["indices"]


def vector_size(vec_col: str) -> F.Column:
    """Size of a sparse ML vector column."""
    return F.unwrap_udt(vec_col)["size"]


def exact_quantile_splits(df: DataFrame, col: str, n: int) -> list[float]:
    """Bucket boundaries at the i/n quantiles, exactly, for ``Bucketizer``.

    The q quantile is the smallest value whose cumulative count reaches q x
    rows -- the same answer Spark's quantile summary gives with zero error --
    but computed from per-value counts and range-bucketed running totals, so
    the column is never gathered in one place; only the n - 1 boundaries reach
    the driver.  Duplicates collapse; the ends are -inf and +inf.
    """
    per = df.groupBy(F.col(col).alias("v")).agg(F.count(F.lit(1)).alias("n")).where(F.col("v").isNotNull())
    cum = running_totals(per, "v", ["n"])
    probs = [i / n for i in range(1, n)]
    row = cum.agg(*[F.min(F.when(F.col("cum_n") >= F.lit(p) * F.col("total_n"), F.col("v"))).alias(f"q{i}")
                    for i, p in enumerate(probs)]).first()
    inner = sorted({float(x) for x in row if x is not None}) if row is not None else []
    return [float("-inf")] + (inner or [0.0]) + [float("inf")]


def quantile_bucket(df: DataFrame, col: str, n: int = QUANTILE_BUCKETS, out: str | None = None, relative_error: float = 0.0) -> DataFrame:
    """M6: quantile buckets of a numeric column.

    ``relative_error=0``: exact boundaries (``exact_quantile_splits``) applied
    by a ``Bucketizer`` -- equal to ``QuantileDiscretizer(relativeError=0)``
    without its whole-column summary on the driver.  Otherwise Spark's
    ``QuantileDiscretizer`` with its distributed sketch.
    """
    out = out or f"{col}_bucket"
    if relative_error <= 0:
        return Bucketizer(splits=exact_quantile_splits(df, col, n), inputCol=col, outputCol=out).transform(df)
    q = QuantileDiscretizer(inputCol=col, outputCol=out, numBuckets=n, relativeError=relative_error)
    return q.fit(df).transform(df)


def minmax(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """M5 + M7: scalar -> 1-d vector -> min-max scaled to [0, 1] (constant -> 0.5)."""
    vec = f"{col}_vec"
    v = VectorAssembler(inputCols=[col], outputCol=vec).transform(df)
    scaled = MinMaxScaler(inputCol=vec, outputCol=f"{col}_scaled_vec").fit(v).transform(v)
    return scaled.withColumn(out or f"{col}_scaled", vector_to_array(f"{col}_scaled_vec")[0])


def rating_features(ratings: DataFrame, buckets: int = QUANTILE_BUCKETS) -> DataFrame:
    """M8: item rating count / average / variance, then a Pipeline of exact
    quantile buckets of the count (Bucketizer on exact splits, as
    QuantileDiscretizer with zero error would choose) and MinMaxScaler(average)."""
    stats = written(item_rating_variance(ratings))  # read by the splits, the scaler and the transform
    stats = VectorAssembler(inputCols=["avg_rating"], outputCol="avg_rating_vec").transform(stats)
    pipe = Pipeline(stages=[
        Bucketizer(splits=exact_quantile_splits(stats, "rating_count", buckets), inputCol="rating_count", outputCol="rating_count_bucket"),
        MinMaxScaler(inputCol="avg_rating_vec", outputCol="scaled_avg_rating_vec"),
    ])
    out = pipe.fit(stats).transform(stats)
    return out.withColumn("scaled_avg_rating", vector_to_array("scaled_avg_rating_vec")[0])
