"""Operations of a training-data pipeline: mixing, classifiers, near copies, filters, extraction, counts.

Functions of this package that run inside tasks are sent along with the job, so executors need no
copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
