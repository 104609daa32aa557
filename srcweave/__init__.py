"""Source-corpus analytics on Spark: files become relations, checks become queries."""

import sys

from pyspark import cloudpickle

# Functions handed to Python workers travel with the job, so executors need
# no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
