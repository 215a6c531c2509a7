"""Operators that prepare language-model training data.

Their Python helpers travel to the executors by value, so workers need no copy of this
package on their path.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
