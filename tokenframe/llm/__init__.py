"""Operators for preparing training text at corpus scale.

Functions that run inside tasks travel with the job, so that executors need no copy of
this package on their path.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
