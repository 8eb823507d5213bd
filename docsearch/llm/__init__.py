"""Operators for large training corpora; nothing else in the package imports them.

Functions that run in Python workers are sent by value, so the workers need no
installed copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
