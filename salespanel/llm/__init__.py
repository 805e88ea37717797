"""Operators that turn raw text tables into training data.

Nothing else in the library imports this subpackage. Its functions travel to Python
workers by value, so executors need none of its files on their import path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
