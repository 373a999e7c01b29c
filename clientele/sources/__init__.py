"""Sources and sinks: explicit schemas, the test-data star mapping, table writers."""

from clientele.sources.sinks import read_table, write_table
from clientele.sources.testdata import Star, load_star

__all__ = ["Star", "load_star", "read_table", "write_table"]
