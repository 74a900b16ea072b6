"""Starmill: raw retail files in, a checked star schema out, on plain Spark DataFrames.

``functions``  Column builders: parsing, recoding, date parts, exact money.
``operators``  DataFrame operators: keep-latest, lookup joins, unknown members, checks.
``sources``    File scans and literal lookup relations.
``sinks``      Contract-checked, all-or-nothing table publication.
``plans``      Table contracts, the silver and gold plans, and the full refresh.
``workload``   Test-table derivations, registered queries and their SQL oracles.
"""
