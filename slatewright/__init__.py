"""slatewright: ranked content feeds built as Spark jobs.

Every function takes and returns DataFrames (or Columns); nothing on the data
path is collected to the driver except lists whose length is a parameter.
"""

__version__ = "0.1.0"

import sys

from pyspark import cloudpickle

# functions sent to tasks take the package's code along, so executors need not have it installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
