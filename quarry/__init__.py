"""quarry: text, URL, weather, keyed-table and link-graph analytics on Spark DataFrames."""

__version__ = "0.1.0"
