"""Operators for preparing training data. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Python workers get the helpers of this package with the task, so it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
