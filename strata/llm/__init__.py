"""Operators for large text collections; nothing else in the package imports this one.

Each module holds one operator with its own interface; ``queries`` applies them
to the supplied tables. Functions that run in tasks are sent with their code, so
executors need the public libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
