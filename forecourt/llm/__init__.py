"""Operators for preparing language-model training data; see the module of each.

What tasks run is sent to the executors by value: they need numpy and pyarrow, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
