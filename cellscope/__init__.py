"""cellscope: audience analytics over mobile-network signalling, on Spark."""

import sys as _sys

# Pandas UDFs and the stateful processor are defined in this package.  They
# are pickled by value, so executor workers and the driver-side runner of
# transformWithStateInPandas need no copy of the package on their path.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle: import by reference
    pass
