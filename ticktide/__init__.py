"""ticktide: hour-keyed enrichment and online learning over tick streams, on Spark."""

from ticktide.session import build_session, prepare

__all__ = ["build_session", "prepare"]
