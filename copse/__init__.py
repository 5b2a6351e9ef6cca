"""copse: bagged classifiers as Spark DataFrame jobs.

Every step takes and returns DataFrames. Fitted models are small tables
keyed by ``model_id`` so that many bags are trained in the same jobs, and
all randomness comes from md5 of (seed, model, key) so that a recomputed
partition (lost executor, speculative task) draws the same rows.

Layout:
  sources/    text scan and ranked-line parsing, profile files, reports
  functions/  column expressions (hash draws, distances, bins, gini)
  operators/  profile, encode, bagging, tree, bayes, knn, vote, evaluate
  plans/      lineage cutting, checked broadcast, ensembles, query catalog
  streaming/  scoring a stream against a fitted model
"""

__version__ = "0.1.0"
