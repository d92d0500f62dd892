"""Lamella: analytics over collections of semi-structured specification documents, on Spark.

Operators are functions ``DataFrame -> DataFrame`` parameterised by column names
(``lamella.operators``); scans and sinks are in ``lamella.sources``, scalar
expressions in ``lamella.functions``, named queries with their SQL counterparts in
``lamella.plans``, stream processing in ``lamella.streaming``. Text operators live
in ``lamella.llm``, which nothing else here imports.
"""
