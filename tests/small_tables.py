"""The smallest driver tables, for tests (a module of its own: two conftest files share one name)."""

SF_SMALL = "/root/testdata/sf0.001"
