"""ratewise: rating prediction as Spark DataFrame plans.

Sub-packages:
  sources    - schemas, CSV / JSON-lines readers, prediction sinks, stand-in tables
  functions  - column expressions (null-guarded counts, map flattening, guards, clipping)
  operators  - joins / aggregates / windows: scope, statistics, similarity, neighbours,
               profiles, features, models, evaluation
  plans      - end-to-end pipelines (item-kNN, hybrid, feature model) and the query registry
  streaming  - micro-batch scoring of pair files with Structured Streaming
"""

from ratewise.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
