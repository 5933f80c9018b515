"""Layered table analytics as plain DataFrame transforms.

``functions``  column expressions (text, dates, money)
``sources``    delimited scans, layer tables, result export
``operators``  DataFrame -> DataFrame transforms, free of table names
``plans``      the sales configuration and the end-to-end run
"""
