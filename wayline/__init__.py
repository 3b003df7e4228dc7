"""Vehicle-telematics analytics as composable Spark DataFrame stages."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the plan, so executors need no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
