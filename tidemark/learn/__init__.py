"""Learners that fit many models at once: features binned once, trees grown level
by level for all folds, windows and presets together.

Functions that run inside Spark's Python workers are pickled by value, so
executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
