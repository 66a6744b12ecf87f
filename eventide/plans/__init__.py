"""Named queries over the test tables: each binds operators to tables and carries the
equivalent oracle SQL. Importing this package registers all of them."""

from eventide.plans import (cdc, feeds, geo, joins, ranking, records, registry,  # noqa: F401
                            streams, windowing)
from eventide.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
