"""Analytics of environmental sensor readings on Spark."""

from hazemill.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
