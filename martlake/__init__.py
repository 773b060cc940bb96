"""martlake: retail analytics operators expressed as Spark DataFrame plans.

Layers
------
sources    driver tables, canonical retail bindings, CSV landing, staged publish
functions  column-level helpers (money sums, day arithmetic, stripping, ratios)
operators  reusable distributed operators (keys, references, quantiles,
           global rank / prefix sums, next-in-sequence, bootstrap, profiles)
plans      facts, marts, quality report, gates and business analyses
streaming  incremental landing of the source files
"""

from martlake.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
