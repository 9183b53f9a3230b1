"""Decision-history analytics on Spark: versioned rules, documents, and training-data operators.

The package's functions travel to the Python workers by value, so that executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
