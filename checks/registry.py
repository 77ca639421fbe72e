"""All registered queries with the SQL that checks them."""

from __future__ import annotations

from importlib import import_module

MODULES = ("core", "metric", "rule", "upkeep", "linkage", "page")


def registered() -> dict:
    found: dict = {}
    for module in MODULES:
        found.update(import_module(f"checks.{module}").Q)
    return found
