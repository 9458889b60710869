"""Operators for preparing training data; nothing else in the library imports this package.

Functions of this package that run in tasks travel with the job, so executors need not have it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
