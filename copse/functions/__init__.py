from copse.functions.draws import uniform, poisson_cuts, poisson_weight, hash52
from copse.functions.vectors import l1_distance, l2_distance, distance, projection
from copse.functions.argmax import argmax_label

__all__ = [
    "uniform", "poisson_cuts", "poisson_weight", "hash52",
    "l1_distance", "l2_distance", "distance", "projection", "argmax_label",
]
