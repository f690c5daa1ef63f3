"""Operators for a training-data pipeline over the document tables.

Nothing outside this subpackage imports it. Functions that run inside Spark
tasks are shipped to the executors by value, so the executors need no copy of
this package on their own path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
