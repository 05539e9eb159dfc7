"""Registered queries: one module per operator family, each with its SQL twin."""
from importlib import import_module

FAMILIES = (
    "clauses",
    "aggregates",
    "joins",
    "windows",
    "flat",
    "lists",
    "scalars",
    "docs",
    "ingest",
    "attribution",
    "streams",
)


def load():
    for family in FAMILIES:
        import_module(f"{__name__}.{family}")
