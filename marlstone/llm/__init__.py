"""Training-data pipeline operators.

Nothing outside this package imports it.  Functions that run inside Python
workers are pickled by value; cached tables are named by their module, so the
repository must be on the executors' path (or shipped by --py-files).
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
