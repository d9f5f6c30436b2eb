"""riskspark — risk-adjustment and care-gap analytics as Spark DataFrame plans.

Every public operator is a pure function ``(DataFrame, ..., params) -> DataFrame``:
no actions, no driver loops over data, no Python UDFs. Rule tables are small
DataFrames passed in as arguments (see ``riskspark.sources.reference``).
"""

__version__ = "0.1.0"
