"""Named queries over the driver's tables, each beside its SQL."""

from __future__ import annotations

from loquarium.plans import corpus, events, manifests, scoring, sessions, texts


def _all():
    return {**scoring.QUERIES, **events.QUERIES, **texts.QUERIES, **corpus.QUERIES, **sessions.QUERIES, **manifests.QUERIES}


def queries():
    return {name: run for name, (run, _) in _all().items()}


def oracle_sql():
    return {name: sql for name, (_, sql) in _all().items() if sql}
