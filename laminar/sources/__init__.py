"""Inputs and outputs: test-table fixtures, layer reads/writes, lineage, catalog."""

from laminar.sources import layers, testdata

__all__ = ["layers", "testdata"]
