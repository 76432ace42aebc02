"""shopseg: retail customer analytics as Spark DataFrame operators.

Transactions are cleaned and winsorized, rolled up into one feature row per
user, scaled / one-hot encoded / projected, segmented by hierarchical
clustering (with small niches split off and reattached), profiled, and mined
for support / confidence / lift rules between items.

Every operator takes and returns DataFrames; see the sub-packages:

* ``sources``    typed transaction reads, test-table mapping, sinks
* ``functions``  column expressions and the distributed exact quantile
* ``operators``  cleaning, features, matrix, clustering, silhouette, rules
* ``plans``      end-to-end compositions (rule levels, variants, hybrid)
* ``streaming``  the core / niche split as an incremental file job
"""

from shopseg.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
