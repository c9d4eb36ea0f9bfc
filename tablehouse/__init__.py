"""tablehouse: analytics for multi-player card-table data, written as Spark jobs.

Layers, from the bottom up:

``functions``  column expressions (rules, money, cards)
``operators``  frame-in, frame-out building blocks (scans, top-1, pairs, percentiles)
``sources``    readers and writers
``plans``      the jobs: one function per data product
``streaming``  the log ingest
"""
