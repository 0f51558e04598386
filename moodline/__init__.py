"""Entity sentiment time series on Spark.

Posts and articles are cleaned, tagged and scored per named entity, rolled up to
daily ratios, joined with a daily probability series and fitted by regression.
Every step takes and returns a DataFrame (or a Column).
"""

__version__ = "0.1.0"
