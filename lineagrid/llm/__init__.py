"""Operators that prepare text corpora: deduplication, filtering, extraction, counting and mixing.

Every operator takes and returns DataFrames and does its work in Spark tasks.  Common rules:

* a null text counts as an empty text, and no column but the ones named by arguments is looked at;
* repeated rows are kept as rows and get the same result each;
* intermediate tables are written under ``spark.checkpoint.dir`` (see :mod:`lineagrid.llm.shared`).
"""
