"""Sources and sinks: logical-input registry, test-data adapters, the cut-score seed, writers."""

from kestrel.sources.registry import Inputs, load_inputs, read_table

__all__ = ["Inputs", "load_inputs", "read_table"]
