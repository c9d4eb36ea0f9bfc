"""Operators of a training-data pipeline, one module per operator.

Nothing else in the library imports this package.  Its functions travel to the Python
workers by value, so a cluster needs the package on the driver only.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
