"""News-article lake on Spark: pages and JSON batches in, one clean article table out."""
