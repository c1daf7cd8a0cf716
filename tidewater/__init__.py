"""tidewater: Spark-native news-lead ingestion and reporting operators.

Every public operator is a DataFrame -> DataFrame (or Column -> Column)
function.  Current time is always passed in (``as_of``) so results are
reproducible; nothing is collected to the driver.
"""

__all__ = ["session"]
