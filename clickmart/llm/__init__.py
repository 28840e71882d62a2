"""Operators for building training data for language models.

Nothing else in the library imports this package. Its functions run inside Python workers, so the package is pickled
by value: executors need no copy of the repository on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
