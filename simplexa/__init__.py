"""simplexa: compositional count tables as Spark DataFrame operators.

Tables are long: one row per (Sample, FeatureID) with a non-negative Value; an
absent row means zero.  Every operator takes and returns DataFrames and builds
a lazy plan; see README.md for the few documented exceptions.
"""

import sys

from pyspark import cloudpickle

from simplexa.session import local_session

# Functions that run in tasks travel with the plan, so executors need numpy,
# pandas and pyarrow but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["local_session"]
