"""kinweave: entity resolution and data preparation on PySpark DataFrames."""

import os

os.environ.setdefault("OMP_NUM_THREADS", "1")  # one thread for each Python worker, as Spark has it on a cluster

__version__ = "0.1.0"
