"""bundlelake: PySpark operators for nested clinical JSON bundles.

Raw bundle files -> landing table -> exploded entries -> typed staging
tables -> patient dimension and clinical facts -> quality audit ->
published version -> dashboard aggregates.  Every step is a function
from DataFrames to DataFrames built on Spark's own operators.
"""

__version__ = "0.1.0"
