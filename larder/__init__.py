"""Analytics over tables whose rows carry a nested array of measurements.

``sources`` reads and writes snapshots, tables and results, ``functions`` holds
column expressions, ``operators`` maps DataFrames to DataFrames, and ``plans``
combines them into the labelling paths, the SQL catalogue and the batch job.
"""
