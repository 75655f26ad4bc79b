"""Training-data operators.  Nothing outside this package imports it.

Functions that run in tasks travel with the job, so executors need the public
libraries but not this package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
