"""Operators of a training-data pipeline on whole tables of documents and conversations.

Nothing outside this folder imports it.
"""

import sys

from pyspark import cloudpickle

# Executors run the functions of this folder without having it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
