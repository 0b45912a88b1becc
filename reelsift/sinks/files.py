"""File sinks (K1-K3, K9, K10).  Each returns the path it wrote."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_samples(df: DataFrame, path: str, files: int | None = None) -> str:
    """K1: headered CSV, overwrite; parallel part files unless ``files`` is given."""
    out = df.coalesce(files) if files else df
    out.write.mode("overwrite").option("header", True).csv(path)
    return path


def embedding_line(id_col: str, emb: str = "emb") -> Column:
    """``id:v1 v2 ... vn`` text of one vector."""
    vals = F.transform(F.col(emb), lambda x: x.cast("float").cast("string"))
    return F.concat(F.col(id_col).cast("string"), F.lit(":"), F.array_join(vals, " "))


def write_embeddings(df: DataFrame, path: str, id_col: str = "item_id", emb: str = "emb") -> str:
    """K2/K3: one ``id:v1 v2 ...`` line per vector."""
    df.select(embedding_line(id_col, emb).alias("value")).write.mode("overwrite").text(path)
    return path


def write_recommendations(df: DataFrame, path: str) -> str:
    """K9: ``user,item,score`` lines (no header, no leading blank line)."""
    df.select("user_id", "item_id", "score").write.mode("overwrite").csv(path)
    return path


def write_scored_pairs(df: DataFrame, path: str) -> str:
    """``user,item,rating,score`` lines."""
    df.select("user_id", "item_id", "rating", "score").write.mode("overwrite").csv(path)
    return path
