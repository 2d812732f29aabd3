"""pluvio — sensor-series and incident-record analytics as Spark DataFrame plans.

Sub-packages:
  functions  Column-expression helpers (null rules, date parsing, rounding)
  operators  DataFrame -> DataFrame operators (series, quality, records, reshape,
             weather, coverage, geo, joins, running totals)
  sources    readers for delimited / tab files, generated grids and calendars
  sinks      table publication (parquet, csv, display formats)
  plans      stand-in inputs from the driver tables, pipelines, the query catalogue
"""
__version__ = "0.1.0"
