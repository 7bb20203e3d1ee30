"""Orderwell: messy order feeds to trustworthy analytics tables, on Spark.

Every function takes DataFrames and returns DataFrames; nothing runs until a
table is written or read by the caller.  Layers:

* ``sources``    landing raw feeds, reading and writing tables
* ``functions``  column expressions (text, dates, money)
* ``operators``  DataFrame to DataFrame steps (dedup, quality, merge, star)
* ``plans``      the steps put together (silver, star, questions, whole load)
* ``streaming``  the same load driven by newly arrived files
"""
