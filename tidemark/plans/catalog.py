"""All registered queries. Importing a module registers its plans."""

from tidemark.plans import (  # noqa: F401
    scans,
    scalars,
    joins,
    totals,
    windows,
    sets,
    dimensions,
    tables,
    checks,
    spend,
    questions,
    feature_tables,
    streams,
    likeness,
    upkeep,
    assurance,
)
from tidemark.plans.registry import NATIVE, ORACLES, QUERIES  # noqa: F401
