"""Registered queries over the given tables, with the SQL each is checked against."""

import sys

from pyspark import cloudpickle

# Its task functions travel with the job, so workers need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
