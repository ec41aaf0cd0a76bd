"""reviewflow: review-polarity data preparation, model training and endpoint
event analytics on Spark DataFrames and Structured Streaming."""

import sys as _sys

__version__ = "0.1.0"

# Functions handed to Python workers (mapInPandas and friends) are pickled by value,
# so executors need no copy of this package on their path.
try:
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001  (older cloudpickle: ship the package with addPyFile)
    pass
