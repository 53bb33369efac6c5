"""Training-data operators: duplicates, contamination, secrets, personal data, toxicity, quality, tokens, language models.

Nothing outside this folder imports it. Its functions travel to the executors by value, so executors need no copy of
the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
