"""Registered queries: every operator on the given tables, with the SQL that must agree with it."""

from assay.queries import (  # noqa: F401  (each module registers its queries)
    aggregates,
    columns,
    jobs,
    lookups,
    models,
    scalars,
    selection,
    sources,
)
from assay.queries.registry import REGISTRY  # noqa: F401
