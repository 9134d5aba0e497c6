"""Catalogue of registered queries."""

from importlib import import_module

from dustline.registry.core import CATALOGUE

GROUPS = ("scans", "scalars", "quality", "joins", "calibrate", "exposures", "products", "validations", "maintenance",
          "geometry", "learning", "experiments", "live")


def load() -> dict:
    for group in GROUPS:
        import_module(f"dustline.registry.{group}")
    return CATALOGUE
