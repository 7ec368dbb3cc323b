"""Record, text and event processing on Spark DataFrames.

``functions``   Column builders and the field-path language
``operators``   DataFrame to DataFrame operators
``sources``     readers, writers and merges
``streaming``   Structured Streaming forms
``plans``       the registered queries over the given tables and their SQL
"""
