"""Incremental and stateful processing."""
