"""Training-data operators: deduplication, decontamination, packing, scoring,
token counting and page extraction as Spark jobs.

Each module holds one operator with its own interface; ``queries`` binds them
to the test tables. Nothing outside this package imports it.
"""

import sys

from pyspark import cloudpickle

# Functions of this package that run in Python workers travel by value, so a
# cluster's executors need no copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
