"""Operators for preparing language-model training data.

Functions that run inside tasks are shipped by value, so executors need
Spark, pyarrow and numpy but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
