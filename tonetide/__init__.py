"""tonetide: market, news-sentiment and event-tone features as lazy Spark DataFrame operators.

Every operator is a ``DataFrame -> DataFrame`` function (usable with ``df.transform``).
The library never builds or stops a SparkSession and collects nothing to the driver;
the only actions it runs are ``spark.ml`` fits and explicit sink writes.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run in Python workers are sent by value, with the module code they use, so
# executors need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
