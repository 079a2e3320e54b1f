"""Operators for preparing training corpora.

Functions of this subpackage that run on executors travel with the job, so that
nothing but Spark and the third-party libraries has to be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
