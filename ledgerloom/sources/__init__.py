"""Table schemas, readers, writers and the binding of the star-schema test tables."""

from ledgerloom.sources.schemas import Tables

__all__ = ["Tables"]
