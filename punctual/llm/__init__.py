"""Training-data operators. Nothing else in the package imports this one."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Functions sent to executors travel whole, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
