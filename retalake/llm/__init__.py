"""Operators for large-scale training data. Nothing else in the library imports this subpackage.

Functions that run inside Python workers are shipped with their code, so that
executors need no copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
