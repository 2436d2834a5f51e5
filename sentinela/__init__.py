"""sentinela: infection-surveillance analytics as Spark DataFrame operators."""

from .session import build_session, scratch_path, shared_root

__all__ = ["build_session", "scratch_path", "shared_root"]
