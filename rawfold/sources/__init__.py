"""Sources and sinks: raw relation discovery/union, incremental watermark, merge and table layout."""

from rawfold.sources.relations import (
    CatalogSource, MappingSource, Relation, discover, ilike, like_regex, match_relations, matches,
    relation_name, union_relations,
)

__all__ = [
    "CatalogSource", "MappingSource", "Relation", "discover", "ilike", "like_regex",
    "match_relations", "matches", "relation_name", "union_relations",
]
