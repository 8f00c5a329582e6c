"""tidewater: marine-report quality control and release building on Spark.

Every operator takes and returns DataFrames and is expressed with Spark SQL
expressions, joins, aggregations and windows.  Sub-packages:

* ``sources``   - scans (fixed-width reports, pipe tables, editions) and sinks
* ``functions`` - Column -> Column expressions (calendar, grid cells, checks,
                  spherical geometry, humidity, solar angle, text)
* ``operators`` - DataFrame -> DataFrame operators (selection, joins,
                  aggregations, per-platform windows, buddy checks, metadata)
* ``plans``     - composed jobs (monthly QC, CDM levels, metadata chain) and
                  the adapters that turn the driver's test tables into inputs
* ``streaming`` - intentionally empty: every reference entry point reads
                  closed monthly files (see its module docstring)
"""

__version__ = "0.1.0"
