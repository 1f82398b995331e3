"""All plan modules of the core, in one place."""

from __future__ import annotations

from leafwork.plans import annotations, chunks, corpus, layout, matching, nested, sections, texts
from leafwork.plans.registry import Query

MODULES = (nested, sections, texts, chunks, layout, matching, corpus, annotations)


def queries() -> dict[str, Query]:
    return {name: query for module in MODULES for name, query in module.registry.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.registry.sql.items()}
