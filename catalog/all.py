"""Every registered query; importing this module fills the registry."""

from __future__ import annotations

import importlib

from catalog.registry import ORACLES, QUERIES  # noqa: F401

for _module in ("q_sources", "q_shape", "q_pick", "q_joins", "q_aggregate", "q_tracking", "q_business", "q_money",
                "q_changes", "q_plans", "q_reports"):
    importlib.import_module(f"catalog.{_module}")
