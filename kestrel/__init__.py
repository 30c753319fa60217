"""kestrel: exact, tested data jobs on the Spark DataFrame API.

Sub-packages:
    sources    readers and sinks (ordered line text, positional records, delimited bulk loads, CSV export)
    functions  column expressions (safe numbers, Unicode strip, fixed-offset local dates, parity rounding)
    operators  composed operators (ordered scans, shape tools, quality checks, statistics, time series,
               star consolidation, layouts, features, model)
    plans      the query catalogue run on the shared driver tables, with independent SQL oracles
    streaming  incremental refresh of stored daily summaries with Structured Streaming
"""

__version__ = "0.1.0"
