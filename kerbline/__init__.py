"""kerbline: trip tables, clickstream windows and versioned tables as plain Spark jobs."""

from kerbline.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
