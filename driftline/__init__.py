"""driftline: online machine learning on Spark tables and streams.

Every operator takes DataFrames and returns DataFrames.  The heavy work is distributed aggregation of mergeable
statistics; only models of a bounded size (tree nodes, rules, micro-clusters, class dictionaries) reach the driver.
"""

from driftline.api import hoeffding_classifier, microcluster_kmeans, rules_regressor, streaming_kmeans, streaming_linear

__all__ = ["hoeffding_classifier", "rules_regressor", "microcluster_kmeans", "streaming_kmeans", "streaming_linear"]
