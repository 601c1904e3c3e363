"""Writers. Each returns nothing; readers pick the data up again from the path."""

from timbrelake.sinks.clustered import with_cluster_key, write_clustered
from timbrelake.sinks.tables import (
    append_history,
    append_partitioned,
    overwrite,
    write_bucketed,
    write_catalogue,
    write_lines,
    write_shard,
    write_shards,
    write_tsv,
)

__all__ = [
    "with_cluster_key", "write_clustered",
    "append_history", "append_partitioned", "overwrite", "write_bucketed", "write_catalogue", "write_lines",
    "write_shard", "write_shards", "write_tsv",
]
