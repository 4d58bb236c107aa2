"""Operators for preparing large training corpora.

Functions of this package are shipped to executors by value, so workers need not have the
package on their own path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
