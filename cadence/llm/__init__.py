"""Operators of a training-data pipeline over whole corpora.

Nothing else in the library imports this subpackage. Its task functions are
shipped by value, so executors need no installed copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
