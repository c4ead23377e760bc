"""sitelens: crawl-and-search analytics over HTML page tables on Spark.

Pages are rows; lines, tokens, postings, links and crawl rounds are all
DataFrame operators built from ``pyspark.sql.functions``.  See README.md.
"""

__version__ = "0.1.0"
