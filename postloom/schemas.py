"""Schemas of the tables that the library reads and writes."""

from pyspark.sql import types as T

POSTING_COLUMNS = ("id", "title", "description", "location", "timestamp")

POSTINGS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
])

WATERMARK = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("max_id", T.LongType()),
])

PROCESSED = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("cell", T.LongType()),
    T.StructField("lo", T.LongType()),
    T.StructField("hi", T.LongType()),
])

RUN_REPORT = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("batches", T.LongType()),
    T.StructField("tokens", T.LongType()),
    T.StructField("truncations", T.LongType()),
    T.StructField("mean_tokens", T.DoubleType()),
    T.StructField("cost", T.DoubleType()),
    T.StructField("total_cost", T.DoubleType()),
    T.StructField("seconds", T.DoubleType()),
])

COUNTRY_DICTIONARY = T.MapType(
    T.StringType(),
    T.StructType([
        T.StructField("Countries", T.ArrayType(T.StructType([
            T.StructField("country_name", T.StringType()),
            T.StructField("country_code", T.StringType()),
            T.StructField("capital_english", T.StringType()),
            T.StructField("subdivisions", T.ArrayType(T.StructType([
                T.StructField("subdivisions_code", T.StringType()),
                T.StructField("subdivisions_name", T.StringType()),
            ]))),
        ]))),
    ]),
)

CHAT_RESPONSE = T.StructType([
    T.StructField("choices", T.ArrayType(T.StructType([
        T.StructField("message", T.StructType([T.StructField("content", T.StringType())])),
    ]))),
    T.StructField("usage", T.StructType([
        T.StructField("prompt_tokens", T.IntegerType()),
        T.StructField("completion_tokens", T.IntegerType()),
    ])),
])

MATCH_ANSWER = T.ArrayType(T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("suitability", T.StringType()),
    T.StructField("explanation", T.StringType()),
]))

MATCH_RESULT_COLUMNS = ("id", "title", "link", "location", "summary", "suitability", "explanation")
