"""Intermediate tables in the folder that all executors share."""

from seedloom.session import written

__all__ = ["written"]
