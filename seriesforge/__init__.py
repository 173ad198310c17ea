"""seriesforge: macro time series and document operators on PySpark DataFrames."""

import sys

from pyspark import cloudpickle

# The few vectorised helpers travel with the job, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
