"""tallyforge: Spark operators for score reporting and data quality work.

Every operator takes DataFrames and returns DataFrames.  Control sheets (a
list of dicts or a small DataFrame) are validated on the driver and compiled
into native column expressions, so that Catalyst plans the row work.
"""

__version__ = "0.1.0"
