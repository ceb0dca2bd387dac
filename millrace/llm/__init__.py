"""Operators for preparing training text at scale, and their registered queries.

Functions of this subpackage travel to executors by value, so the package has to
be installed on the driver only.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
