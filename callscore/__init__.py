"""callscore: call-stream risk analytics on Spark.

Sub-packages
------------
functions   column expressions (text, scoring, arrays) — JVM-side, no per-row Python
operators   DataFrame operators (calls, cleaning, splits, metrics, fusion, matrices,
            signal, segments, models) and the skew-safe building blocks
            (prefix: adaptive running totals, halo: bounded windows, grouped:
            per-partition group walks)
sources     table and message sources/sinks (CSV/Parquet, JSON envelope, Kafka)
streaming   Structured Streaming: per-call keyed state, streaming sessioniser,
            ordered-wave replay with checkpoint restarts
plans       fixture views, registered queries and their DuckDB twins
"""

__version__ = "0.1.0"
