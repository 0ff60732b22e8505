"""Operators for large-scale training-data work.

Nothing else in the library imports this package.  Its functions run in
Python workers; they are pickled by value so that executors need no
installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
