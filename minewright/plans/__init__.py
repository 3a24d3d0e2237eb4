"""Registered queries, one module per operator family."""

from importlib import import_module

MODULES = (
    "texts", "similarities", "searches", "clicks", "assignments", "classifiers", "trees", "neighbourhoods", "margins", "factors", "formulas", "clusters", "files",
)


def load() -> None:
    for name in MODULES:
        import_module(f"{__name__}.{name}")
