"""Readers: columnar data sets, catalogues, manifests, file listings, one-row tables."""

from timbrelake.sources.files import list_by_prefix, list_files, read_files, sample_names
from timbrelake.sources.listing import list_folders
from timbrelake.sources.tables import (
    catalogue_paths,
    header_of,
    open_bucketed,
    read_bucketed,
    read_catalogue,
    read_dataset,
    read_lines,
    read_manifest,
    read_tsv,
    rows_of,
)

__all__ = [
    "catalogue_paths", "header_of", "list_by_prefix", "list_files", "list_folders", "open_bucketed", "read_bucketed", "read_catalogue",
    "read_dataset", "read_files", "read_lines", "read_manifest", "read_tsv", "rows_of", "sample_names",
]
