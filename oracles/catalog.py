"""All oracle statements."""

from oracles import analyses, basics, features, models, regressions

ORACLES = {**basics.ORACLES, **analyses.ORACLES, **features.ORACLES, **models.ORACLES, **regressions.ORACLES}
