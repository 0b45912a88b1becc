"""reelsift: recommendation analytics as Spark DataFrame jobs.

Every operator is a ``DataFrame -> DataFrame`` function built from native
Spark expressions (Catalyst plans, whole-stage codegen where Spark has it);
trained models use Spark ML estimators.  The most used entry points are
re-exported here; see README.md for the module map.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# functions that run in Python workers travel with their code: executors need no copy of this package on their path
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])


from reelsift.operators.cf import cross_validate_als, predict, train_als  # noqa: F401
from reelsift.operators.embedding import item_sequences, train_item2vec, user_embeddings  # noqa: F401
from reelsift.operators.encode import minmax, multi_hot, one_hot, quantile_bucket, rating_features  # noqa: F401
from reelsift.operators.evaluate import auc, rmse  # noqa: F401
from reelsift.operators.item_features import add_item_features, item_stats, latest_item_features  # noqa: F401
from reelsift.operators.neighbors import ann, exact_top_k, lsh_buckets, similar_items  # noqa: F401
from reelsift.operators.rank import recommend, score_pairs  # noqa: F401
from reelsift.operators.recall import recall, top_items, top_items_per_genre  # noqa: F401
from reelsift.operators.samples import add_label, random_split, sample_rows, split_and_save, split_by_time  # noqa: F401
from reelsift.operators.training import build_samples  # noqa: F401
from reelsift.operators.user_features import add_user_features, latest_user_features  # noqa: F401
from reelsift.plans import jobs  # noqa: F401

__version__ = "0.1.0"
