"""Training-data operators.

Functions that run in Python workers are shipped by value, and broadcast
objects of this package with their classes (:class:`stellate.llm.common.Shipped`),
so the executors need no copy of this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
