"""All registered queries of this folder."""

from . import centroids, decontaminate, jaccard, knn, lempel_ziv, lm_scoring, packing, quality, reply_trees, sharding, spelling, suffix_dedup, url_filter  # noqa: F401
from .common import ORACLE, QUERIES  # noqa: F401
