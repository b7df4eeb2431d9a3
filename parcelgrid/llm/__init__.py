"""Operators for preparing training text; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Task functions travel with the job, so workers need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
