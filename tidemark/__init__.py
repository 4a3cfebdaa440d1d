"""Warehouse operators on Spark DataFrames."""

from tidemark.context import RunContext
from tidemark.session import build_session

__all__ = ["RunContext", "build_session"]
