"""Where rows go: keyed tables, routed topics, the raw archive."""

from .archive import archive_by_day
from .folded import FoldedTable
from .keyed import KeyedTable
from .routed import routed_files, routed_topics

__all__ = ["FoldedTable", "KeyedTable", "archive_by_day", "routed_files", "routed_topics"]
