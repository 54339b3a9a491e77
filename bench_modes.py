"""Direct mode (one scan of the raw rows) against warehouse mode (the stored panels): no filter, one municipio, five municipios, three runs each."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from epidw.plans.shared_refresh import by_panel, refresh_all_direct, refresh_stored

# the same places in the spelling of the raw file and of the warehouse
SCENARIOS = {
    "none": ((), ()),
    "one": ((" Vitoria ",), ("VITORIA",)),
    "five": (
        (" Vitoria ", "serra", "São Mateus", "Vitória", "Cachoeiro de Itapemirim"),
        ("VITORIA", "SERRA", "SÃO MATEUS", "VITÓRIA", "CACHOEIRO DE ITAPEMIRIM"),
    ),
}
RUNS = 3


def timed(action: Callable):
    began = time.perf_counter()
    result = action()
    return time.perf_counter() - began, result


def compare_modes(raw: DataFrame, tables) -> dict[str, dict[str, float]]:
    """Seconds per refresh: the first run apart, then the mean of three alternating runs, and their ratio."""
    found = {}
    for scenario, (spelled_raw, spelled_clean) in SCENARIOS.items():
        direct = lambda: by_panel(refresh_all_direct(raw, spelled_raw))  # noqa: B023, E731
        warehouse = lambda: by_panel(refresh_stored(tables, spelled_clean))  # noqa: B023, E731
        first = timed(direct)[0], timed(warehouse)[0]
        runs = [(timed(direct)[0], timed(warehouse)[0]) for _ in range(RUNS)]
        direct_mean, dw_mean = (sum(times) / RUNS for times in zip(*runs))
        found[scenario] = {
            "direct_cold": round(first[0], 3), "dw_cold": round(first[1], 3),
            "direct_mean": round(direct_mean, 3), "dw_mean": round(dw_mean, 3),
            "speedup": round(direct_mean / dw_mean, 2),
        }
    return found
