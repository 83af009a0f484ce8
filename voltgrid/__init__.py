"""Charging-network analytics as Spark DataFrame operators.

Sub-packages
------------
functions   column-level expressions (text cleaning, geodesy, scoring)
sources     readers and writers for files, and views over the test tables
operators   DataFrame -> DataFrame building blocks
plans       the end-to-end demand and network plans and the query catalog
streaming   incremental month ingest
"""
