"""Imports every module that registers queries."""

from __future__ import annotations

import importlib

MODULES = ("scores", "gate", "functions", "arrays", "corpus", "variants", "lyrics", "metrics", "streams")


def load() -> None:
    for name in MODULES:
        importlib.import_module(f"noteflow.plans.{name}")


load()
