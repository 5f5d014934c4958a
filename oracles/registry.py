"""All oracle SQL by query name."""

from oracles import gold, ingest, monitor, quality, reconcile, sqlshapes

ORACLES = {**gold.ORACLES, **quality.ORACLES, **ingest.ORACLES, **reconcile.ORACLES, **monitor.ORACLES,
           **sqlshapes.ORACLES}
