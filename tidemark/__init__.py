"""tidemark: analytics operators for PySpark DataFrames and streams."""

import sys

from pyspark import cloudpickle

# The few Python functions that run inside tasks travel with the task, so executors need
# numpy, pandas and pyarrow, but no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
