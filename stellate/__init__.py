"""stellate: component labelling of sharded item tables on Apache Spark."""

from .operators.components import connected_components, vertices_from_edges
from .operators.messages import (assign_rounds, classify_messages, format_messages,
                                 parse_edges, round_snapshots)
from .operators.neighbors import neighbor_edges, neighbors, stored_neighbors
from .operators.table import (assign_dense_ids, contract_edges, lookup_uid, lookup_uids,
                              populate, relabel)
from .plans.rounds import merge_rounds, snapshot_components
from .plans.store import ComponentStore
from .session import get_session

__all__ = [
    "ComponentStore", "assign_dense_ids", "assign_rounds", "classify_messages",
    "connected_components", "contract_edges", "format_messages", "get_session", "lookup_uid",
    "lookup_uids", "merge_rounds", "neighbor_edges", "neighbors", "parse_edges", "populate",
    "relabel", "round_snapshots", "snapshot_components", "stored_neighbors",
    "vertices_from_edges",
]
