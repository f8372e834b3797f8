"""Corpus token budgeting on Spark: normalize, classify, compress, price and
score whole document collections as lazy DataFrame operators."""

import sys

from pyspark import cloudpickle

from .config import DEFAULT_CONFIG, OptimizerConfig  # noqa: F401
from .plans.pipeline import run_pipeline  # noqa: F401

# functions that run in Python workers are pickled by value: workers need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
