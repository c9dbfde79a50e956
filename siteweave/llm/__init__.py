"""Operators for preparing language-model training data.

Nothing outside this folder imports it. The functions that run in Python workers
travel there by value, so that the workers need not have this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
