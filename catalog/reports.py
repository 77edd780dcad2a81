"""Filters, aggregates, ordering and vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import embedded_rows, embedded_sql, N_TOKENS_SQL, POSTINGS_SQL, hashed_sql, postings, query, table, truncated_sql
from postloom.functions.money import EMBEDDING_PRICES, completion_cost, embedding_cost
from postloom.operators.embedding import assemble_embeddings, dimension_check, embed_column, mean_pool
from postloom.operators.filters import country_filter, id_lookup, id_lookup_in, recent_filter
from postloom.operators.places import tag_countries
from postloom.operators.index import build_index, search_index
from postloom.operators.ordering import chunk_rows, order_check, restore_order
from postloom.operators.search import nearest_postings, query_vector
from postloom.operators.stats import batch_stats, budget_tokens, cost_total, describe_table, distinct_locations, location_token_counts, row_count
from postloom.session import fresh_path
from postloom.sources.countries import country_values


@query("recent_filter", "SELECT event_id, ts, value FROM events WHERE ts::DATE >= DATE '2024-01-16'")
def _(spark, sf):
    return recent_filter(table(spark, sf, "events"), as_of="2024-01-30", ts="ts").select("event_id", "ts", "value")


@query("id_lookup", "SELECT vec_id AS id, label FROM embeddings WHERE vec_id = 33")
def _(spark, sf):
    return id_lookup(table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "label"), 33)


@query("id_lookup_in", """
    SELECT doc_id AS id, lang, source FROM documents
    WHERE doc_id = 1 AND doc_id IN (SELECT doc_id FROM labels WHERE doc_id = 1)""")
def _(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "lang", "source")
    return id_lookup_in(docs, table(spark, sf, "labels").select(F.col("doc_id").alias("ids")), 1)


def country_dictionary(spark, sf):
    """Regions as continents and nations as countries: both tables have a fixed size."""
    nation, region = (table(spark, sf, n) for n in ("nation", "region"))

    def named(prefix):
        return F.concat(F.lit(prefix), F.col("n_nationkey").cast("string"))

    countries = nation.select("n_regionkey", F.struct(
        F.col("n_name").alias("country_name"), named("N").alias("country_code"), named("Capital ").alias("capital_english"),
        F.array(*[
            F.struct(named(f"D{i}-").alias("subdivisions_code"), named(f"District {i} of ").alias("subdivisions_name")) for i in (1, 2)
        ]).alias("subdivisions"),
    ).alias("country"))
    continents = countries.join(region, F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name").agg(F.collect_list("country").alias("Countries"))
    return continents.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("r_name", F.struct("Countries"))))).alias("dictionary"))


ALL_VALUES_SQL = """
    SELECT n_name AS country_name, unnest(['name', 'code', 'capital', 'subdivision_code', 'subdivision_name', 'subdivision_code', 'subdivision_name']) AS kind,
        unnest([n_name, 'N' || n_nationkey, 'Capital ' || n_nationkey, 'D1-' || n_nationkey, 'District 1 of ' || n_nationkey,
            'D2-' || n_nationkey, 'District 2 of ' || n_nationkey]) AS value
    FROM nation"""
VALUES_SQL = f"{ALL_VALUES_SQL} WHERE n_name = 'NATION_1'"


@query("country_values", VALUES_SQL)
def _(spark, sf):
    return country_values(country_dictionary(spark, sf), "NATION_1")


def _locations(spark, sf):
    nation, region = (table(spark, sf, n) for n in ("nation", "region"))
    customer = table(spark, sf, "customer")
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("c_custkey").alias("id"), F.concat_ws(" ", "r_name", "n_name", "c_mktsegment", F.lit("Remote")).alias("location"))
    )


_LOCATIONS_SQL = """SELECT c_custkey AS id, concat_ws(' ', r_name, n_name, c_mktsegment, 'Remote') AS location
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


@query("country_filter", f"""
    SELECT id, lower(location) AS location FROM ({_LOCATIONS_SQL})
    WHERE EXISTS (SELECT 1 FROM ({VALUES_SQL}) WHERE regexp_matches(lower(location), lower(value)))""")
def _(spark, sf):
    return country_filter(_locations(spark, sf), country_values(country_dictionary(spark, sf), "NATION_1"))


@query("country_filter_literal", f"""
    SELECT id, location FROM ({_LOCATIONS_SQL})
    WHERE EXISTS (SELECT 1 FROM ({VALUES_SQL}) WHERE contains(lower(location), lower(value)))""")
def _(spark, sf):
    return country_filter(_locations(spark, sf), country_values(country_dictionary(spark, sf), "NATION_1"), literal=True, lowercase=False)


@query("country_tags", f"""
    WITH places AS ({_LOCATIONS_SQL}), vals AS (SELECT DISTINCT country_name, lower(value) AS value FROM ({ALL_VALUES_SQL}))
    SELECT DISTINCT id, location, country_name AS country FROM places, vals WHERE contains(lower(location), value)""")
def _(spark, sf):
    """All countries of every location, in one pass over the locations."""
    tagged = tag_countries(_locations(spark, sf), country_values(country_dictionary(spark, sf)))
    return tagged.select("id", "location", F.explode("countries").alias("country"))


_COUNTED_SQL = f"SELECT doc_id, {N_TOKENS_SQL.format(text='text')} AS n FROM documents"


@query("batch_stats", f"""
    SELECT count(*) AS batches, sum(n)::BIGINT AS tokens, count(*) FILTER (n > 1000) AS truncations,
        sum(n) / count(*) AS mean_tokens, round(sum(n) / 1000 * 0.0004::DOUBLE, 4)::DOUBLE AS cost FROM ({_COUNTED_SQL})""")
def _(spark, sf):
    return batch_stats(budget_tokens(table(spark, sf, "documents", ["doc_id", "lang", "text"])), "openai")


@query("embedding_cost", f"""
    WITH per AS (SELECT lang, sum(n)::BIGINT AS tokens FROM ({_COUNTED_SQL}) JOIN documents USING (doc_id) GROUP BY lang)
    SELECT lang, tokens, round(tokens / 1000 * 0.0004::DOUBLE, 4)::DOUBLE AS cost_openai, 0.0::DOUBLE AS cost_e5 FROM per""")
def _(spark, sf):
    counted = budget_tokens(table(spark, sf, "documents", ["doc_id", "lang", "text"]))
    per = counted.groupBy("lang").agg(F.sum("n_tokens").alias("tokens"))
    return per.select("lang", "tokens", *[embedding_cost("tokens", m).alias(f"cost_{m}") for m in EMBEDDING_PRICES])


def _rounded_sql(tokens: str, price: str) -> str:
    """``round(tokens / 1000 * price, 3)`` on the binary value, in whole numbers.

    A double times a power of two is exact, and so is what follows in 128-bit integers.
    """
    unit = f"{1 << 70}::HUGEINT"
    scaled = f"((({tokens} / 1000 * {price}::DOUBLE) * {float(1 << 70)!r}::DOUBLE)::HUGEINT * 1000)"
    whole, rest = f"({scaled} // {unit})", f"({scaled} % {unit})"
    up = f"({rest} > {1 << 69}::HUGEINT OR ({rest} = {1 << 69}::HUGEINT AND {whole} % 2 = 1))"
    return f"(({whole} + CASE WHEN {up} THEN 1 ELSE 0 END)::DOUBLE / 1000.0::DOUBLE)"


_COSTS_SQL = f"""
    SELECT l_orderkey, l_linenumber, l_partkey, model, CASE model
        WHEN 'gpt-3.5-turbo' THEN {_rounded_sql('l_orderkey', '0.0015')} + {_rounded_sql('l_partkey', '0.002')}
        WHEN 'gpt-3.5-turbo-16k' THEN {_rounded_sql('l_orderkey', '0.003')} + {_rounded_sql('l_partkey', '0.004')}
        ELSE 0.0::DOUBLE END AS cost
    FROM (SELECT *, CASE l_returnflag WHEN 'A' THEN 'gpt-3.5-turbo' WHEN 'N' THEN 'gpt-3.5-turbo-16k' ELSE 'other' END AS model FROM lineitem)"""


def _calls(spark, sf):
    """Order lines as calls: order and part numbers stand for token counts."""
    model = F.when(F.col("l_returnflag") == "A", "gpt-3.5-turbo").when(F.col("l_returnflag") == "N", "gpt-3.5-turbo-16k").otherwise("other")
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", model.alias("model"))
    return lines.withColumn("cost", completion_cost("l_orderkey", "l_partkey", "model"))


@query("completion_cost", _COSTS_SQL)
def _(spark, sf):
    return _calls(spark, sf)


@query("cost_total", f"SELECT count(*) AS calls, sum(cost::DECIMAL(20, 3))::DOUBLE AS total_cost FROM ({_COSTS_SQL})")
def _(spark, sf):
    return cost_total(_calls(spark, sf))


def _describe_sql() -> str:
    parts = []
    for column in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"):
        stats = {
            "count": f"count({column})::DOUBLE", "mean": f"avg({column})", "std": f"stddev_samp({column})", "min": f"min({column})",
            "25%": f"quantile_cont({column}, 0.25)", "50%": f"quantile_cont({column}, 0.5)", "75%": f"quantile_cont({column}, 0.75)",
            "max": f"max({column})",
        }
        parts += [f"SELECT '{column}' AS \"column\", '{s}' AS stat, round({e}, 6)::DOUBLE AS value FROM lineitem" for s, e in stats.items()]
    return " UNION ALL ".join(parts)


@query("describe_table", _describe_sql)
def _(spark, sf):
    lines = table(spark, sf, "lineitem")
    described = describe_table(lines, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return described.withColumn("value", F.round("value", 6))


@query("distinct_locations", f"SELECT DISTINCT location FROM ({_LOCATIONS_SQL})")
def _(spark, sf):
    return distinct_locations(_locations(spark, sf))


@query("location_token_counts", rf"""
    SELECT token, count(*) AS n FROM (SELECT unnest(string_split_regex(location, '\s+')) AS token FROM ({_LOCATIONS_SQL}))
    WHERE token <> '' GROUP BY token ORDER BY n DESC, token""")
def _(spark, sf):
    return location_token_counts(_locations(spark, sf))


@query("row_count", "SELECT count(*) AS n FROM documents")
def _(spark, sf):
    return row_count(table(spark, sf, "documents"))


_POOLED_SQL = """
    SELECT label AS seq_id, pos, round(avg(v), 6)::DOUBLE AS value FROM (
        SELECT label, (p - 1)::INTEGER AS pos, CASE WHEN embedding[1] >= 0 THEN embedding[p]::DOUBLE END AS v
        FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS p FROM embeddings))
    GROUP BY ALL"""


def _token_vectors(spark, sf):
    """Vectors as tokens of the sequence named by their label; those with a negative first element are padding."""
    return table(spark, sf, "embeddings").select(
        F.col("label").alias("seq_id"), (F.col("embedding")[0] >= 0).cast("int").alias("mask"), F.col("embedding").alias("vec"))


def _long_vectors(df, key):
    return df.select(key, F.posexplode("embedding").alias("pos", "value")).withColumn("value", F.round(F.col("value").cast("double"), 6))


@query("mean_pool", _POOLED_SQL)
def _(spark, sf):
    return _long_vectors(mean_pool(_token_vectors(spark, sf)), "seq_id")


@query("chunk_rows", """
    SELECT id, place // 15 AS chunk, (place % 15)::INTEGER AS idx
    FROM (SELECT doc_id AS id, row_number() OVER (ORDER BY n_chars, doc_id) - 1 AS place FROM documents)""")
def _(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "n_chars")
    return chunk_rows(docs, ["n_chars", "id"], 15).select("id", "chunk", "idx")


@query("restore_order", "SELECT doc_id AS id, n_chars FROM documents ORDER BY doc_id")
def _(spark, sf):
    return restore_order(table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "n_chars"))


@query("order_check", """
    WITH placed AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS place FROM documents)
    SELECT place // 50 AS chunk, (place % 50)::INTEGER AS idx, 'missing' AS problem FROM placed
    WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def _(spark, sf):
    """Labelled documents are the answered ones; the others miss their response."""
    asked = chunk_rows(table(spark, sf, "documents").select("doc_id"), "doc_id", 50)
    return order_check(asked, asked.join(table(spark, sf, "labels"), "doc_id", "left_semi"))


def _hash_query_sql(prefix: str, source: str, key: str) -> str:
    """Vectors of what the model reads: the first 512 tokens of the prefixed text."""
    full = f"SELECT {key}, '{prefix}' || text AS text FROM {source}"
    return f"""WITH {hashed_sql(f"SELECT {key}, {truncated_sql('text', 512)} AS text FROM ({full})", key, 'text')}
    SELECT {key}, pos, round(value, 6)::DOUBLE AS value FROM hashed"""


@query("embed_column", _hash_query_sql("", "documents", "doc_id"))
def _(spark, sf):
    return _long_vectors(embed_column(table(spark, sf, "documents", ["doc_id", "text"]).select("doc_id", "text")), "doc_id")


@query("query_vector", _hash_query_sql("query: ", "benchmark", "item_id"))
def _(spark, sf):
    return _long_vectors(query_vector(table(spark, sf, "benchmark")), "item_id")


@query("embed_cut", f"""
    WITH {hashed_sql(f"SELECT doc_id, {truncated_sql('text', 16)} AS text FROM documents", 'doc_id', 'text')}
    SELECT doc_id, pos, round(value, 6)::DOUBLE AS value FROM hashed""")
def _(spark, sf):
    """A model that reads 16 tokens: nearly all texts are cut."""
    docs = table(spark, sf, "documents", ["doc_id", "text"])
    return _long_vectors(embed_column(docs, max_input_tokens=16), "doc_id")


@query("assemble_embeddings", f"""
    WITH budgeted AS (SELECT id, timestamp, {truncated_sql('description', 1000)} AS job_info FROM ({POSTINGS_SQL})),
    {embedded_sql('budgeted', 'job_info')}""")
def _(spark, sf):
    budgeted = budget_tokens(postings(spark, sf).withColumnRenamed("description", "text"))
    return embedded_rows(assemble_embeddings(budgeted), "job_info")


@query("dimension_check", "SELECT len(embedding)::INTEGER AS dim, count(*) AS n FROM embeddings GROUP BY ALL")
def _(spark, sf):
    return dimension_check(table(spark, sf, "embeddings"))


NEAREST_SQL = """
    WITH centroids AS (
        SELECT query_id, list(m ORDER BY p) AS q FROM (
            SELECT label::BIGINT AS query_id, p, avg(embedding[p]::DOUBLE) AS m
            FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS p FROM embeddings) GROUP BY ALL)
        GROUP BY query_id),
    scored AS (
        SELECT query_id, vec_id AS id, round(list_cosine_similarity(embedding::DOUBLE[], q), 6)::DOUBLE AS score
        FROM embeddings, centroids),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id)::INTEGER AS rank FROM scored)
    SELECT query_id, rank, id, score FROM ranked WHERE rank <= 10"""


def _label_means(vectors):
    """Each label's mean vector as the query."""
    tokens = vectors.select(F.col("label").alias("query_id"), F.lit(1).alias("mask"), F.col("embedding").alias("vec"))
    return mean_pool(tokens, "query_id")


@query("nearest_postings", NEAREST_SQL)
def _(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return nearest_postings(vectors.select(F.col("vec_id").alias("id"), "embedding"), _label_means(vectors), k=10)


@query("nearest_indexed", NEAREST_SQL)
def _(spark, sf):
    """The same from an inverted-file index, which is built first."""
    vectors, path = table(spark, sf, "embeddings"), fresh_path(spark, "index")
    build_index(vectors.select(F.col("vec_id").alias("id"), "embedding"), path)
    return search_index(spark, path, _label_means(vectors), k=10).rows


NEAREST_DOCUMENTS_SQL = f"""
    {hashed_sql(f"SELECT doc_id, {truncated_sql('text', 512)} AS text FROM documents", "doc_id", "text")},
    documents_v AS (SELECT doc_id AS id, list(value ORDER BY pos) AS v FROM hashed GROUP BY doc_id),
    {hashed_sql(f"SELECT item_id, {truncated_sql("'query: ' || text", 512)} AS text FROM benchmark", "item_id", "text", suffix="2")},
    items_v AS (SELECT item_id AS query_id, list(value ORDER BY pos) AS q FROM hashed2 GROUP BY item_id),
    scored AS (
        SELECT query_id, id, round(list_cosine_similarity(v, q), 6)::DOUBLE AS score FROM documents_v, items_v
        WHERE list_max(v) > 0),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id)::INTEGER AS rank FROM scored),
    nearest AS (SELECT query_id, rank, id, score FROM ranked WHERE rank <= 5)"""


def nearest_documents(spark, sf):
    docs = embed_column(table(spark, sf, "documents", ["doc_id", "text"]).select(F.col("doc_id").alias("id"), "text"))
    items = query_vector(table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text"))
    return nearest_postings(docs.select("id", "embedding"), items.select("query_id", "embedding"), k=5)


@query("nearest_documents", f"WITH {NEAREST_DOCUMENTS_SQL} SELECT * FROM nearest")
def _(spark, sf):
    return nearest_documents(spark, sf)
