"""Operators for preparing training data: one module each, queries in ``queries``.

Task code of this package travels with the job (pickled by value), so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
