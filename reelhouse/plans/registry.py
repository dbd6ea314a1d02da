"""All registered queries (importing the modules fills the registry)."""

from reelhouse.plans import queries as _q
from reelhouse.plans import io_queries as _io  # noqa: F401
from reelhouse.plans import ml_queries as _ml  # noqa: F401
from reelhouse.plans import enrich_queries as _en  # noqa: F401

QUERIES = _q.QUERIES
ORACLES = _q.ORACLES
