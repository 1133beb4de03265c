"""hexvault: a Spark-native event vault, spatial marts and serving-query library.

Every public function takes and returns DataFrames (or Columns); nothing pulls fact
data to the driver. See README.md for the module map.
"""

__version__ = "0.1.0"
