"""shopmarts: an online-shop medallion pipeline and its marts, built on Spark.

Raw files -> bronze -> silver -> gold marts -> business questions, data-quality
checks, batch retrieval and evaluation statistics.  Every operator is a plain
function from DataFrames to a DataFrame made of Spark's own operators.
"""

__version__ = "0.1.0"
