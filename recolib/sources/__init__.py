"""Sources: fixture tables, text parsers, result store."""

from recolib.sources.fixtures import Fixtures

__all__ = ["Fixtures"]
