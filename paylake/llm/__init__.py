"""Operators of a training-data pipeline (language identification, secret
scanning, LM scoring, chat formatting, packing, de-duplication, token
statistics, quality rules, decontamination).

Nothing outside this subpackage imports it.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage go to Python workers by value, so that workers need not have
# the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
