"""watchfold: behaviour analytics over access events, written for Spark.

Every step is a function from DataFrames to DataFrames.  Steps that learn
something (`fit_*`) return plain tables or small frozen dataclasses; steps that
use it (`apply_*`, `attach_*`, `score_*`) are lazy and keyed by ``event_id``.
"""

__version__ = "0.1.0"
