"""The article record and the fixed values that stand for "missing"."""

from pyspark.sql import types as T

ARTICLE_COLUMNS = ["content", "id", "published_at", "source", "title", "url"]

ARTICLE_SCHEMA = T.StructType([T.StructField(name, T.StringType(), True) for name in ARTICLE_COLUMNS])

HITS_SCHEMA = T.StructType([
    T.StructField("hits", T.ArrayType(T.StructType([
        T.StructField("post_title", T.StringType()),
        T.StructField("post_date", T.LongType()),
        T.StructField("permalink", T.StringType()),
        T.StructField("content", T.StringType()),
    ]))),
])

# What stands in a record when a field could not be read.
NO_DATE = "1970-01-01 00:00:00"
NO_CONTENT = "No content"
NO_TITLE = "No Title"

# Limits of a crawl run. The jobs take all new articles and stop at any known one unless they are told
# these limits.
MAX_NEWS = 500
BATCH_SIZE = 100
RECENT_IDS = 15

DATE_FORMAT = "yyyy-MM-dd HH:mm:ss"
