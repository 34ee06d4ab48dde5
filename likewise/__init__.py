"""likewise: find the catalog items most similar to a requested item, on Spark.

Items are described by named attribute values.  More matching attributes
make an item more similar; at an equal count, a match on an alphabetically
earlier attribute name weighs more.
"""

from .errors import ItemNotFound, TooManyAttributes
from .operators.batch import (batch_top_k, batch_top_k_indexed, build_subset_index,
                              candidate_pairs, missing_requests, subset_heads, subset_rows,
                              top_k_from_index)
from .operators.open_batch import batch_top_k_open
from .operators.lookup import exclude_item, lookup_item, require_item, target_values
from .operators.rank import rank_candidates, top_k_names, top_k_similar, top_k_weights
from .operators.score import (digit_score_compat, match_indicators, similarity_open,
                              similarity_score)
from .operators.value_join import batch_top_k_joined
from .operators.shape import attributes_long, discover_names, flatten_attributes
from .sources.catalog import cached, read_catalog, to_map, write_catalog_json
from .operators.upkeep import build_upkept_index, live_items, top_k_from_upkept, update_index
from .plans.session import OwnedTables
from .sources.stored import build_term_index, read_stored, search_terms, store_catalog
from .sources.tables import append_and_count, append_once, append_once_and_count, committed_count, committed_rows

__all__ = [
    "ItemNotFound", "OwnedTables", "TooManyAttributes",
    "append_once", "append_once_and_count", "build_term_index", "build_upkept_index", "committed_count",
    "committed_rows", "live_items", "read_stored", "search_terms", "store_catalog", "top_k_from_upkept",
    "update_index",
    "append_and_count", "attributes_long", "batch_top_k", "batch_top_k_indexed",
    "batch_top_k_joined", "batch_top_k_open", "build_subset_index", "top_k_from_index",
    "cached", "candidate_pairs", "digit_score_compat", "discover_names", "exclude_item",
    "flatten_attributes", "lookup_item", "match_indicators", "missing_requests",
    "rank_candidates", "read_catalog", "require_item", "similarity_open",
    "similarity_score", "subset_heads", "subset_rows", "target_values", "to_map",
    "top_k_names", "top_k_similar", "top_k_weights", "write_catalog_json",
]
