"""Operators for preparing training data for language models.

Nothing else in the library imports this package. Its functions travel to the
executors by value, so a task needs no copy of the package on its own path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
