"""tillroll: reusable business-analytics operators on Spark DataFrames.

Every operator is a function from DataFrames (plus column names and
thresholds) to a lazy DataFrame built from Spark SQL expressions, so the
plan is optimised by Catalyst and re-planned at runtime by AQE.

Packages: ``functions`` (SQL semantics as Column expressions), ``operators``
(reusable operators), ``sources`` (tables, fixed dimensions, derived business
relations, sinks), ``plans`` (the business queries and their registry),
``streaming`` (incremental runs).  ``python -m tillroll`` lists and runs the
registered queries.
"""

__version__ = "0.1.0"

from .session import build_session, checkpoint_dir, configure  # noqa: E402,F401
