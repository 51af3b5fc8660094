import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark import cloudpickle  # noqa: E402

import pairworks  # noqa: E402

cloudpickle.register_pickle_by_value(pairworks)
