"""Scans, sinks and raw schemas."""

from rxlake.sources.files import scan_delimited, scan_with_provenance, with_constant
from rxlake.sources.tables import copy_table, create_layers, read_layer, write_layer

__all__ = [
    "copy_table",
    "create_layers",
    "read_layer",
    "scan_delimited",
    "scan_with_provenance",
    "with_constant",
    "write_layer",
]
