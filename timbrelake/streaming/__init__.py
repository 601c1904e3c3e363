"""Incremental extraction."""

from timbrelake.streaming.incremental import extract_new_files

__all__ = ["extract_new_files"]
