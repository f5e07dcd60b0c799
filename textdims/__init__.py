"""textdims: corpus analytics on Spark DataFrames.

Cleaning, near-duplicate families, keyness, keyword matrices, dimension
scores and group comparison, written as DataFrame operators.
"""

__version__ = "0.1.0"
