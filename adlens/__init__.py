"""adlens: listings analytics on Spark DataFrames.

Raw listing reports or stored HTML pages become typed ad tables; each day's
snapshot is compared with the open ads to find new, still listed and removed
ads; the open-ads table and the removal history are kept as versioned
parquet; price, publication-date and frequency questions are answered per
segment. Every operator is a function from DataFrame(s) to DataFrame(s).
"""

__version__ = "0.1.0"
