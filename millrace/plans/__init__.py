"""The named tables, their publishing and the layer-by-layer runs."""
