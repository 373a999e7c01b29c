"""Folders of the given test tables, under a module name of its own: ``conftest`` is also the
name of a module below ``tests/llm``."""

SMALL = "/root/testdata/sf0.001"
