"""objsync: move business objects between tables and files with Spark DataFrames."""

from objsync.config import ResourceConfig, TargetConfig

__all__ = ["ResourceConfig", "TargetConfig"]
