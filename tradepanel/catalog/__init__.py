"""Every registered query with its SQL counterpart."""

from tradepanel.catalog.registry import oracles, runners  # noqa: F401
