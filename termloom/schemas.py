"""Table schemas."""

from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("external_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

CORPUS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
)

# The canonical index: flat, unique on (term, doc_id).
POSTINGS = T.StructType(
    [
        T.StructField("term", T.StringType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("tf", T.IntegerType()),
    ]
)

# The export form: one row per term and doc-id block, so that no row grows with the corpus.
POSTING_BLOCKS = T.StructType(
    [
        T.StructField("term", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField(
            "postings",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("doc_id", T.LongType()),
                        T.StructField("tf", T.IntegerType()),
                    ]
                )
            ),
        ),
    ]
)

INDEX_STATS = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("build", T.LongType()),
        T.StructField("options", T.StringType()),
        T.StructField("doc_count", T.LongType()),
        T.StructField("posting_count", T.LongType()),
        T.StructField("max_doc_id", T.LongType()),
    ]
)

# Which documents each build holds, also those without a token.
INDEX_IDS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("build", T.LongType()),
    ]
)

QUERIES = T.StructType(
    [
        T.StructField("query_id", T.LongType()),
        T.StructField("q", T.StringType()),
        T.StructField("mode", T.StringType()),
        T.StructField("limit", T.LongType()),
    ]
)

SAMPLES = T.StructType(
    [T.StructField("term", T.StringType()), T.StructField("dur_ms", T.DoubleType())]
)
