"""Every operator applied to the benchmark tables, with the SQL that must give the same rows."""

from hammerprice.queries import (  # noqa: F401  (importing a module registers its queries)
    combining,
    drifting,
    features,
    ingest,
    jobs,
    modelling,
    ordering,
    profiles,
    records,
    splitting,
    streams,
)
from hammerprice.queries.registry import ORACLES, QUERIES  # noqa: F401
