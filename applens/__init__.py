"""applens: device and app analytics on PySpark.

Subpackages:
    functions  - Column builders (text rules, dates, query strings, tokens, codecs)
    sources    - text and JDBC readers, inputs derived from the shared tables
    sinks      - date-routed and single-file text output
    operators  - ratings/metrics, arrivals, phone models, KV export, prefix
                 lookup, click logs, dense ids, ALS recommender
    streaming  - click-log Structured Streaming ETL
    plans      - registered queries, DuckDB oracles, CLI jobs
"""

__version__ = "0.1.0"
