"""tillroll: retail customer analytics as Spark jobs.

Cleaning, enrichment, validation, RFM segmentation, clustering validity,
leakage-safe prediction and serving queries over transaction tables, each a
function from DataFrames to a DataFrame.
"""

__version__ = "0.1.0"
