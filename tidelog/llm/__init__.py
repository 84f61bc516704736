"""Operators of a training-data pipeline. Nothing else in the library imports this package.

Functions of these modules run inside Python tasks. They are shipped with the
task rather than imported there, so that executors need not have the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
