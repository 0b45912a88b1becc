"""Item sequences, user embeddings and item2vec."""

from __future__ import annotations

import math

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelsift.functions import POSITIVE_THRESHOLD, cosine100
from reelsift.operators.positions import HEAVY_ROWS, heavy_keys, heavy_positions, split_heavy
from reelsift.plans.joins import broadcast_within, row_bytes
from reelsift.session import written

# item2vec settings of the reference's embedding job.
ITEM2VEC_DIM = 10
ITEM2VEC_WINDOW = 5
ITEM2VEC_ITERATIONS = 10
ITEM2VEC_PASSES = 5  # iterations over a pair of blocks while they are at hand
# Word2Vec cuts sentences at this length anyway; only its input is cut, never a result.
SENTENCE_ITEMS = 1000


def item_sequences(ratings: DataFrame, threshold: float = POSITIVE_THRESHOLD, heavy_rows: int | None = HEAVY_ROWS) -> DataFrame:
    """Liked items of each user in time order as rows (user_id, pos, item_id), pos from 0.

    Positions come from a row_number over (ts, item_id); users with more than
    ``heavy_rows`` liked items get the same positions from the
    range-partitioned path instead, so no task sorts a whole heavy user.
    """
    liked = ratings.where(F.col("rating") >= threshold).select("user_id", "item_id", "ts")
    heavy = heavy_keys(liked, "user_id", heavy_rows) if heavy_rows else []
    by_user = Window.partitionBy("user_id").orderBy("ts", "item_id")
    if not heavy:
        positioned = liked.withColumn("pos", F.row_number().over(by_user).cast("bigint") - 1)
    else:
        light, hot, _ = split_heavy(liked, "user_id", heavy)
        positioned = light.withColumn("pos", F.row_number().over(by_user).cast("bigint") - 1).unionByName(
            heavy_positions(hot, "user_id", ["ts", "item_id"], sum(n for _, n in heavy))
        )
    return positioned.select("user_id", "pos", "item_id")


def sequence_strings(sequences: DataFrame) -> DataFrame:
    """Each user's whole sequence as one space-joined string (user_id, item_seq, seq_len).

    One row per user is the format, so a row is as long as that user's history; models
    are fed from ``sentences`` instead.
    """
    s = sequences.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("pos", "item_id"))).alias("s"))
    return s.select("user_id", F.array_join(F.transform("s", lambda x: x["item_id"].cast("string")), " ").alias("item_seq"), F.size("s").cast("bigint").alias("seq_len"))


def sentences(sequences: DataFrame, max_len: int = SENTENCE_ITEMS) -> DataFrame:
    """Word2Vec's input: (user_id, chunk, items) pieces of at most ``max_len`` items, the length it cuts at itself."""
    cut = sequences.withColumn("chunk", F.floor(F.col("pos") / max_len).cast("bigint"))
    s = cut.groupBy("user_id", "chunk").agg(F.array_sort(F.collect_list(F.struct("pos", "item_id"))).alias("s"))
    return s.select("user_id", "chunk", F.transform("s", lambda x: x["item_id"].cast("string")).alias("items"))


def vector_bounds(item_emb: DataFrame) -> tuple[int, int]:
    """(rows, longest vector): one small job over the vectors' table."""
    row = item_emb.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("emb")).alias("d")).first()
    return int(row["n"]), max(0, int(row["d"] or 0))


def embedding_dim(item_emb: DataFrame) -> int:
    return vector_bounds(item_emb)[1]


def user_embeddings(ratings: DataFrame, item_emb: DataFrame, dim: int | None = None, divisor: str = "all") -> DataFrame:
    """A13 (+J7): user vector = sum of rated items' vectors / number of ratings.

    ``divisor="all"`` divides by every rating, including items without a
    vector (the reference's rule); ``"matched"`` only by those with one.
    The sum is ``Summarizer.sum`` over ML vectors, a JVM aggregate with a
    map-side partial, so nothing is exploded per dimension and a heavy user is
    combined in every map task before the shuffle; only ratings whose item has
    a vector go into it, the others are only counted.  A user none of whose items has a
    vector gets a zero vector of ``dim`` when given (the reference writes
    zeros), else null.
    """
    rows, width = vector_bounds(item_emb)
    vecs = broadcast_within(item_emb.select("item_id", F.col("emb").cast("array<double>").alias("e")).where("e is not null"), rows, row_bytes(width))
    rated = ratings.select("user_id", "item_id")
    every = rated.join(broadcast_within(item_emb.select("item_id"), rows), "item_id", "left").groupBy("user_id").agg(F.count(F.lit(1)).alias("n_all"))
    sums = rated.join(vecs, "item_id").groupBy(F.col("user_id").alias("_user")).agg(F.count(F.lit(1)).alias("n_matched"), Summarizer.sum(array_to_vector("e")).alias("s"))
    sums = every.join(sums, F.col("user_id").eqNullSafe(F.col("_user")), "left")
    n = F.col("n_all") if divisor == "all" else F.col("n_matched")
    missing = F.array_repeat(F.lit(0.0), dim) if dim is not None else F.lit(None).cast("array<double>")
    total = F.when(F.col("n_matched") > 0, F.transform(vector_to_array("s"), lambda x: x / n)).otherwise(missing)
    return sums.select("user_id", total.alias("emb"))


def train_item2vec(
    sequences: DataFrame,
    dim: int = ITEM2VEC_DIM,
    window: int = ITEM2VEC_WINDOW,
    iterations: int = ITEM2VEC_ITERATIONS,
    seed: int = 42,
    min_count: int = 5,
    partitions: int = 1,
) -> DataFrame:
    """Skip-gram item2vec of ``item_sequences``: (item_id, emb ARRAY<FLOAT>) of every item seen ``min_count`` times.

    Trained by blocks of the vocabulary (``item2vec_blocks``), so neither the driver nor a task holds all of it:
    ``iterations`` passes over all pairs, ITEM2VEC_PASSES of them each time two blocks meet.  Items without a neighbour
    keep their first vector, as in Word2Vec.  ``partitions``: the least number of blocks, which train side by side; the
    vectors depend on it, so it is an argument with a fixed default, never the cluster's size.
    """
    from reelsift.operators import item2vec_blocks as blocks

    sequences = written(sequences)
    epochs = math.ceil(iterations / ITEM2VEC_PASSES)
    vectors = blocks.train_item2vec_blocks(
        blocks.cooccurrence(sequences, window, min_count), dim, seed, epochs=epochs, passes=math.ceil(iterations / max(epochs, 1)), least_blocks=partitions
    )
    often = sequences.where(F.col("item_id").isNotNull()).groupBy("item_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)
    emb = F.coalesce("emb", blocks.first_vector(dim, seed)).alias("emb")
    return written(often.select("item_id").join(vectors.select("item_id", "emb"), "item_id", "left").select("item_id", emb))


def item_vectors(model: DataFrame) -> DataFrame:
    """All item vectors of a trained item2vec model as (item_id, emb ARRAY<FLOAT>)."""
    return model.select("item_id", "emb")


def synonyms(model: DataFrame, item_id, n: int = 20) -> DataFrame:
    """T5 on a trained model: the n most similar items of one item (item_id, similarity): one pass over the vectors, of
    which each task keeps its n best."""
    item_id = int(item_id)
    seed = model.where(F.col("item_id") == item_id).select(F.col("emb").cast("array<double>").alias("seed_emb"))
    others = model.where(F.col("item_id") != item_id).join(F.broadcast(seed))  # one row
    scored = others.select("item_id", (cosine100(F.col("emb").cast("array<double>"), F.col("seed_emb")) / 100).alias("similarity"))
    return scored.orderBy(F.col("similarity").desc(), "item_id").limit(n)


def embedding_job(ratings: DataFrame, dim: int = ITEM2VEC_DIM, seed: int = 42, partitions: int = 1,
                  out_dir: str | None = None):
    """E5: sequences -> item2vec -> item vectors -> user vectors [-> K2/K3 text files].

    Returns (item_emb, user_emb, model); with ``out_dir`` the vectors are also
    written as ``id:v1 v2 ...`` text under ``out_dir/items`` and ``out_dir/users``.
    """
    from reelsift.sinks.files import write_embeddings

    ratings = written(ratings.select("user_id", "item_id", "rating", "ts"))  # read by the sequences and the user vectors
    model = train_item2vec(item_sequences(ratings), dim=dim, seed=seed, partitions=partitions)
    iv = item_vectors(model)
    uv = user_embeddings(ratings, iv, dim=dim)  # dim is known: zero vectors for users without vectors
    if out_dir is not None:
        write_embeddings(iv, f"{out_dir}/items", "item_id")
        write_embeddings(uv, f"{out_dir}/users", "user_id")
    return iv, uv, model
