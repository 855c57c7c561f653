"""Marketplace order analytics as plain Spark DataFrame code."""

from bazaarlens.session import build_session, ship, tune

__all__ = ["build_session", "ship", "tune"]
