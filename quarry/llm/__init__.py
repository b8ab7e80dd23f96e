"""Operators for preparing training text at scale.

Each module holds one operator with a general interface; ``queries.py`` holds
the thin registered queries.  Nothing outside this subpackage imports it.

Functions of this subpackage travel to Python workers by value, so that
executors need not have the repository on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
