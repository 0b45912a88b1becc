"""M1: the full training-sample table (label + item features + user features)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from reelsift.operators.item_features import add_item_features
from reelsift.operators.positions import HEAVY_ROWS, heavy_keys
from reelsift.operators.samples import add_label
from reelsift.operators.user_features import USER_HISTORY, add_user_features


def build_samples(ratings: DataFrame, items: DataFrame, history: int = USER_HISTORY, heavy_rows: int | None = HEAVY_ROWS,
                  numeric: bool = False, **kw) -> DataFrame:
    """P1 -> W9 -> W8: one wide row per rating with at least two prior ratings.

    Heavy users are detected on the ratings (one row per sample, cheaper than
    the joined samples) and handed to the user-feature windows.
    ``numeric=True`` adds ``*_num`` double twins of the two-decimal text features.
    """
    heavy = heavy_keys(ratings, "user_id", heavy_rows) if heavy_rows else []
    samples = add_item_features(add_label(ratings), items, numeric=numeric)
    return add_user_features(samples, history=history, heavy=heavy, numeric=numeric, **kw)
