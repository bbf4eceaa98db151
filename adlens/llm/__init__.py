"""Operations of a training-data pipeline over a corpus of documents (see README, "Corpus operators")."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors whole, so those need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
