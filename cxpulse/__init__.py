"""cxpulse: customer-feedback and service-quality reports on Spark.

Every report is a function from input DataFrames (plus explicit parameters)
to a lazy DataFrame. Nothing is collected inside the library; the only
actions happen in sinks chosen by the caller.
"""

__version__ = "0.1.0"
