"""tabml: supervised learning on tables, every pass over rows on Spark.

Sub-packages:

* ``sources``    reading tables, profiles, model store and report sinks
* ``functions``  shared column expressions and distributed primitives
                 (hash order, exact cutoffs, cumulative sums, vectors)
* ``operators``  roles, label maps, splits, preprocessing, estimators,
                 metrics, curves, diagnostics, scoring
* ``plans``      the train entry and the registered query catalogue
* ``streaming``  scoring a streaming DataFrame with a fitted bundle
"""

from tabml.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
