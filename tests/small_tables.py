"""Where the small test tables are (a module of its own name: ``conftest`` is not importable by name from two folders)."""

SMALL = "/root/testdata/sf0.001"
