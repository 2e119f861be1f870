"""Operators of a training-data pipeline.

Nothing else in the library imports this package. Functions that run inside
Python workers are shipped by value, so executors need numpy and pyarrow but no
copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
