"""Operators for preparing training data: one module each, queries in ``queries``.

Functions that run inside tasks travel to the executors with the task, so the package needs
to be installed on the driver only.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
