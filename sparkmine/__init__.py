"""sparkmine: frequent-itemset mining, mini-batch k-means and small series
operators expressed as plain DataFrame-to-DataFrame functions on Spark.

Layout:
  functions/  column expressions (seeded uniform, distances, subsets)
  sources/    text and table readers, writers, dense indexes
  operators/  itemsets, dataset modifiers, clustering, evaluation, series
  plans/      registered queries, DuckDB oracles, experiment sweeps
  streaming/  the batch operators applied to micro-batches
"""

__version__ = "0.1.0"
