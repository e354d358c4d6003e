"""Operators of a training-data pipeline: ten corpus operators and their queries.

Nothing else in the library imports this subpackage. Its task functions are
pickled by value, so Python workers need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
