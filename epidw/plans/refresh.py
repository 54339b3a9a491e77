"""One dashboard refresh: all panels of a mode."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Row

from epidw.plans import direct, star

Values = Sequence[str]


def refresh_direct(raw: DataFrame, municipios: Values = (), classes: Values = ()) -> dict[str, list[Row]]:
    return refresh(raw, direct.PANELS, municipios, classes)


def refresh_star(tables: star.Tables, municipios: Values = (), classes: Values = ()) -> dict[str, list[Row]]:
    return refresh(tables, star.PANELS, municipios, classes)


def refresh(source, panels: Mapping, municipios: Values = (), classes: Values = ()) -> dict[str, list[Row]]:
    """The rows of every panel, fetched as concurrent Spark jobs. Each panel is a handful of rows."""
    with ThreadPoolExecutor(len(panels)) as pool:
        running = {name: pool.submit(lambda p: p(source, municipios, classes).collect(), panel) for name, panel in panels.items()}
        return {name: future.result() for name, future in running.items()}
