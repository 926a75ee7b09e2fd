"""All registered queries and oracles of the research-corpus operators."""

from __future__ import annotations

from . import answers, base, composites, landings, lookups, rankings, scalars, states, statistics  # noqa: F401


def flagship(spark, sf_dir):
    """Final scores of the corpus and their first hundred."""
    return composites.q5_ranking_view(spark, sf_dir)


def queries() -> dict:
    return dict(base.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(base.ORACLES)
