"""cartwright: retail and experiment analytics as Spark DataFrame jobs.

Layers (each a plain function ``DataFrame(s) -> DataFrame``, no collect inside):

* ``sources``    raw table readers, the TPC-H fixture adapter, sinks
* ``operators``  staging, star schema, analytics marts, experiment models,
                 statistics, data-quality checks, chart/dashboard data
* ``functions``  column-expression helpers (hashing, safe division,
                 distribution functions, display formatting)
* ``plans``      query registry, DuckDB oracle SQL, model build order
* ``streaming``  incremental experiment read-out over a file stream
"""

from cartwright.session import get_session, checkpoint_root

__all__ = ["get_session", "checkpoint_root"]
