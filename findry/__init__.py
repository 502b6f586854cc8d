"""Vector, keyword and hybrid retrieval over Spark tables."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Task functions travel with their code, so executors need no installed copy.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
