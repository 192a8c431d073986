"""shelfspark: a Spark-native product-catalogue pipeline.

Every operator is a pure ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function; I/O lives in ``sources``; compositions in ``plans``.
"""

__version__ = "0.1.0"
