"""vitrine: a Spark-native price-history lake.

Listing pages arrive as a table; card and category extraction, the bronze
loads, the silver tables and the table maintenance helpers are all plain
DataFrame / SQL operators that take and return DataFrames.
"""

__version__ = "0.1.0"
