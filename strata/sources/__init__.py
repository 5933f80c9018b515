from strata.sources.delimited import drift_report, header_columns, scan_delimited, scan_drifting
from strata.sources.export import export_csv, read_export
from strata.sources.layers import LayerTable, layer_path, row_hash, write_layer
from strata.sources.scratch import scratch_base, scratch_dir
from strata.sources.versions import drop_abandoned, publish_layer, read_layer, unordered

__all__ = [
    "LayerTable",
    "drift_report",
    "drop_abandoned",
    "export_csv",
    "header_columns",
    "layer_path",
    "publish_layer",
    "read_export",
    "read_layer",
    "row_hash",
    "scan_delimited",
    "scan_drifting",
    "scratch_base",
    "scratch_dir",
    "unordered",
    "write_layer",
]
