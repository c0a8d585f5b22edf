"""riskweave: bank risk analytics as Spark DataFrame jobs.

``functions``  column expressions (cleaning, bands, ratios, scoring rules)
``sources``    readers, writers, schemas, load audit
``operators``  DataFrame -> DataFrame jobs (joins, KPIs, segments, windows, models)
``streaming``  Structured Streaming jobs over transaction messages
``plans``      the registered queries over the test tables
"""
