"""kalulu: longitudinal HIV-programme warehousing and indicator reports on Spark.

Layers
------
* ``sources``   -- typed table readers/writers and the projection of the
                   driver tables into the clinical schemas.
* ``functions`` -- Column-level helpers (dates, collation, identifiers).
* ``operators`` -- reusable DataFrame operators (latest-per-key, banding,
                   conditional counts, existence flags, EAV pivot).
* ``plans``     -- the cohort, the indicator reports and the warehouse loaders.
* ``streaming`` -- intentionally empty: the reference has no streaming work.
"""

from kalulu.params import ReportParams, period_start

__all__ = ["ReportParams", "period_start"]
