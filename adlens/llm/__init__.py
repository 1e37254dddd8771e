"""Training-data operators (deduplication, decontamination, mixing, output,
classification, search). Nothing outside this package imports it.

The functions that run inside Spark tasks are pickled by value, so executors
need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
