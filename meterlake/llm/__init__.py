"""Training-data operators: toxicity, quality rules, de-duplication, scoring,
fingerprints, tokenising, packing and sharding.

Nothing outside this subpackage imports it; ``queries.py`` registers its
operators and ``corpus_pipeline.py`` at the repository top chains five of them.
"""

import sys

from pyspark import cloudpickle

# Functions of this package that run in tasks travel with them, so executors
# need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
