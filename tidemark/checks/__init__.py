"""One query per operator on the benchmark tables, with the matching SQL."""

import importlib

GROUPS = ("rows", "tables", "reports", "files")


def load_all() -> None:
    """Import the groups, which fills the registry."""
    for group in GROUPS:
        importlib.import_module(f"tidemark.checks.{group}")
