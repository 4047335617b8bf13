"""Item-to-item recommendations from action logs, as Spark DataFrame jobs."""

from linkweave.config import UpdateConfig

__all__ = ["UpdateConfig"]
