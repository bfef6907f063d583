"""ratify: approval-productivity analytics as Spark DataFrame operators.

Service orders are attributed to the internal person who approved them,
classified (kind, item band, vehicle family, severity), weighted in standard
minutes, joined to client price-partner intervals, measured against a
business-time SLA and item reference prices, and totalled per approver week.

Layout:
    sources/    table schemas, readers, parameter tables, sinks, driver analog
    functions/  column expressions (no Python UDFs)
    operators/  DataFrame -> DataFrame building blocks
    plans/      composed plans (the approval fact) and the registered queries
    streaming/  scheduled refresh driven by Structured Streaming
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
