"""Edaphon: soil spectra and laboratory tables, from raw files to scored models, as Spark jobs."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions sent to the executors carry their code, so the workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
