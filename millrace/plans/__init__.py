"""Registered queries over the supplied tables, each with its ANSI SQL equivalent where one exists."""

from __future__ import annotations

from millrace.plans import change_log, core, distributions, files, rollups, space_graph, timeseries
from millrace.plans.base import Entry


def catalogue() -> dict[str, Entry]:
    merged: dict[str, Entry] = {}
    for module in (core, timeseries, rollups, change_log, distributions, space_graph, files):
        for name, entry in module.ENTRIES.items():
            if name in merged:
                raise ValueError(f"registered twice: {name}")
            merged[name] = entry
    return merged
