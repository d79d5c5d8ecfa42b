"""Flight-punctuality lakehouse operators on stock Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function.  Actions happen only
where a table is published (``sources.loads``, with the listing of its files in
``plans.refresh``), where one is put on shared storage (``sources.scratch``), and where the
first lines of a file are read for its header (``sources.delimited``).
"""
