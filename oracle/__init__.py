"""Reference answers in DuckDB SQL for the registered queries."""

from __future__ import annotations

from ledgerlens.registry import VOLUME_REPORTS
from oracle import charts, features, mechanisms, reports
from oracle.base import on_volume


def answers() -> dict[str, str]:
    named = reports.answers()
    learned = features.answers()
    return {
        **named,
        **charts.answers(),
        **learned,
        **mechanisms.answers(),
        **reports.graph_answers(),
        **features.dense_answers({**named, **learned}),
        **{f"v_{name}": on_volume(named[name]) for name in VOLUME_REPORTS},
    }
