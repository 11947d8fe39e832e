"""Operators for building training corpora: encoding, filtering, de-duplication, search, packing.

The package ships its functions to the executors by value, so executors need no copy of it on
their path. Nothing else in the library imports it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
