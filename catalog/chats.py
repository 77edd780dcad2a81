"""Requests, responses, fallbacks, prompts, matches and sections."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from catalog.registry import N_TOKENS_SQL, hashed_sql, postings, query, table, truncated_sql
from catalog.reports import NEAREST_DOCUMENTS_SQL, VALUES_SQL, _rounded_sql, country_dictionary, nearest_documents
from postloom.functions.language import stem_tokens
from postloom.operators import chat
from postloom.operators.embedding import embed_column
from postloom.operators.matching import CV_DELIMITER, POSTINGS_HEADING, SUITABILITY, default_match_instructions, match_prompt, match_results
from postloom.operators.sections import CV_SECTION_LABELS, JOB_SECTION_LABELS, split_summary_sections
from postloom.operators.stats import budget_tokens
from postloom.plans.matching import eligible_postings, prompts_for_cvs
from postloom.plans.retries import scheduled_run
from postloom.plans.summaries import summary_run
from postloom.session import fresh_path
from postloom.sources.countries import country_values, read_country_dictionary
from postloom.sources.tables import run_report_scan


def _text_sql(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _requests_sql(relation: str, key: str, kind: str) -> str:
    head, mark = ("CV: ", "####") if kind == "cv" else ("Job Opening: ", "----")
    settings = chat.REQUEST_KINDS[kind]
    tail = f"'user' AS role, {_text_sql(settings['model'])} AS model, 0::INTEGER AS temperature, {settings['max_tokens']}::INTEGER AS max_tokens FROM {relation}"
    return f"""
    SELECT {key}, 0::INTEGER AS pos, {_text_sql(chat.default_instructions(kind))} AS content, {tail}
    UNION ALL SELECT {key}, 1, {_text_sql(head + mark)} || text || '{mark}', {tail}"""


def _message_rows(requests, *key):
    exploded = requests.select(*key, "model", "temperature", "max_tokens", F.posexplode("messages").alias("pos", "m"))
    return exploded.select(*key, "pos", "m.content", "m.role", "model", "temperature", "max_tokens")


@query("build_requests", _requests_sql("documents", "doc_id", "job"))
def _(spark, sf):
    return _message_rows(chat.build_requests(table(spark, sf, "documents"), "job"), "doc_id")


@query("build_requests_single", _requests_sql("documents", "doc_id", "job_single"))
def _(spark, sf):
    return _message_rows(chat.build_requests(table(spark, sf, "documents"), "job_single"), "doc_id")


@query("build_requests_cv", _requests_sql("conversations", "conv_id, turn", "cv"))
def _(spark, sf):
    return _message_rows(chat.build_requests(table(spark, sf, "conversations"), "cv"), "conv_id", "turn")


def _response(content, prompt_tokens, completion_tokens):
    return F.to_json(F.struct(
        F.array(F.struct(F.struct(content.alias("content")).alias("message"))).alias("choices"),
        F.struct(prompt_tokens.alias("prompt_tokens"), completion_tokens.alias("completion_tokens")).alias("usage")))


@query("parse_responses", f"""
    SELECT conv_id, turn, CASE WHEN role <> 'system' THEN text END AS summary,
        CASE WHEN role <> 'system' THEN length(text)::INTEGER END AS prompt_tokens,
        CASE WHEN role <> 'system' THEN {N_TOKENS_SQL.format(text='text')}::INTEGER END AS completion_tokens,
        CASE WHEN role <> 'system' THEN {_rounded_sql('length(text)', '0.0015')} + {_rounded_sql(N_TOKENS_SQL.format(text='text'), '0.002')} END AS cost
    FROM conversations""")
def _(spark, sf):
    """Turns as answers; those of the system come back broken."""
    turns = table(spark, sf, "conversations")
    text = F.col("text")
    answer = F.when(F.col("role") == "system", F.lit('{"choices": [')).otherwise(_response(text, F.length(text), F.regexp_count(text, F.lit(r"\S+"))))
    return chat.parse_responses(turns.withColumn("response", answer)).select("conv_id", "turn", "summary", "prompt_tokens", "completion_tokens", "cost")


_WORDS_SQL = N_TOKENS_SQL.format(text="d.text")


@query("summarise_with_fallback", f"""
    SELECT d.doc_id AS id, d.text AS original,
        CASE WHEN {_WORDS_SQL} > 50 AND l.quality = 1 THEN 'Title: ' || d.source ELSE d.text END AS summary,
        CASE WHEN {_WORDS_SQL} > 50 AND l.quality = 1 THEN {_rounded_sql('length(d.text)', '0.0015')} + {_rounded_sql('length(d.source)', '0.002')} ELSE 0.0::DOUBLE END AS cost,
        CASE WHEN {_WORDS_SQL} <= 50 THEN 'short' WHEN l.quality = 1 THEN 'ok' ELSE 'failed' END AS status
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def _(spark, sf):
    """Labelled documents were answered: well for quality 1, with broken JSON for quality 0."""
    docs = table(spark, sf, "documents", ["doc_id", "text", "source"]).select(F.col("doc_id").alias("id"), "text", "source")
    labels = table(spark, sf, "labels").select(F.col("doc_id").alias("id"), "quality")
    good = _response(F.concat(F.lit("Title: "), "source"), F.length("text"), F.length("source"))
    responses = docs.join(labels, "id").select("id", F.when(F.col("quality") == 1, good).otherwise(F.lit("{")).alias("response"))
    return chat.summarise_with_fallback(docs, responses)


def _echo_service():
    """Completion stand-in: answers with the model name, one token per request character."""
    import json

    def complete(request: str) -> dict:
        body = json.loads(request)
        content = body["messages"][1]["content"]
        return {"choices": [{"message": {"content": "Title: " + body["model"]}}],
                "usage": {"prompt_tokens": len(content), "completion_tokens": body["max_tokens"]}}

    return complete


@query("summary_run", f"""
    SELECT doc_id AS id, text AS original,
        CASE WHEN {N_TOKENS_SQL.format(text='text')} > 50 THEN 'Title: gpt-3.5-turbo' ELSE text END AS summary,
        CASE WHEN {N_TOKENS_SQL.format(text='text')} > 50
            THEN {_rounded_sql("(length(text) + length('Job Opening: --------'))", '0.0015')} + {_rounded_sql('400', '0.002')} ELSE 0.0::DOUBLE END AS cost,
        CASE WHEN {N_TOKENS_SQL.format(text='text')} > 50 THEN 'ok' ELSE 'short' END AS status
    FROM documents""")
def _(spark, sf):
    docs = table(spark, sf, "documents", ["doc_id", "text"]).select(F.col("doc_id").alias("id"), "text")
    return summary_run(docs, _echo_service, fresh_path(spark, "answers"), pause=0.0).summaries


@query("summary_report", f"""
    SELECT n AS reports, sum(cost::DECIMAL(20, 3))::DOUBLE AS total_cost FROM (
        SELECT DISTINCT text, {_rounded_sql("(length(text) + length('Job Opening: --------'))", '0.0015')} + {_rounded_sql('400', '0.002')} AS cost
        FROM documents WHERE {N_TOKENS_SQL.format(text='text')} > 50), (SELECT 2::BIGINT AS n) GROUP BY n""")
def _(spark, sf):
    """The summary half of the run report: two runs, of which the second finds all answers."""
    docs = table(spark, sf, "documents", ["doc_id", "text"]).select(F.col("doc_id").alias("id"), "text")
    answers, report = fresh_path(spark, "answers"), fresh_path(spark, "report")
    for _run in range(2):
        summary_run(docs, _echo_service, answers, pause=0.0, report_path=report)
    total = F.sum(F.col("total_cost").cast("decimal(20,3)")).cast("double")
    return run_report_scan(spark, report).agg(F.count(F.lit(1)).alias("reports"), total.alias("total_cost"))


def _service_of_run(run):
    """A service that improves: in its n-th run (from 0) it fails requests whose text's length modulo 8 is above n."""
    def service():
        answer, frame = _echo_service(), len("Job Opening: --------")

        def complete(request):
            import json

            if (len(json.loads(request)["messages"][1]["content"]) - frame) % 8 > run:
                raise ConnectionError("later")
            return answer(request)

        return complete

    return service


# Seconds after the start at which the runs of the query begin: two seconds in, nothing is due.
_RUN_SECONDS = (0, 2, 5, 30, 155, 780, 100_000)


@query("retry_schedule", f"""
    WITH t AS (SELECT doc_id AS id, length(text) % 8 AS c, {N_TOKENS_SQL.format(text='text')} > 50 AS long FROM documents),
    asked AS (SELECT id, CASE WHEN NOT long THEN 0 WHEN c = 0 THEN 1 WHEN c <= 2 THEN 2 WHEN c <= 5 THEN c ELSE 5 END AS n, long, c FROM t)
    SELECT id, n::INTEGER AS attempts, CASE WHEN NOT long THEN 'short' WHEN c <= 5 THEN 'ok' ELSE 'failed' END AS status FROM asked""")
def _(spark, sf):
    """Seven runs with a schedule: what failed is asked again when it is due, five times at most, and never after that."""
    docs = table(spark, sf, "documents", ["doc_id", "text"]).select(F.col("doc_id").alias("id"), "text")
    start, path = datetime(2024, 1, 1, tzinfo=timezone.utc), fresh_path(spark, "attempts")
    for run, second in enumerate(_RUN_SECONDS):
        done = scheduled_run(docs, _service_of_run(run), path, clock=lambda: start + timedelta(seconds=second), pause=0.0)
    return done.summaries.select("id", "attempts", "status")


def _upper_tokenizer():
    """A deterministic tokenizer for the hook: the runs of capital letters and of others are tokens."""
    import re

    class Runs:
        def encode(self, text):
            return [m.group() for m in re.finditer(r"[A-Z]+|[^A-Z]+", text)]

        def decode(self, tokens):
            return "".join(tokens)

    return Runs()


@query("tokenizer_hook", """
    WITH t AS (SELECT doc_id AS id, regexp_extract_all(text, '[A-Z]+|[^A-Z]+') AS ts FROM documents)
    SELECT id, len(ts)::INTEGER AS n_tokens, len(ts) > 20 AS truncated, array_to_string(ts[1:20], '') AS text FROM t""")
def _(spark, sf):
    docs = table(spark, sf, "documents", ["doc_id", "text"]).select(F.col("doc_id").alias("id"), "text")
    return budget_tokens(docs, 20, tokenizer=_upper_tokenizer)


def _first_letters():
    """A deterministic stemmer for the hook."""
    return lambda word: word[:4]


@query("stemmer_hook", r"""
    WITH w AS (SELECT doc_id AS id, lang, string_split(text, ' ') AS ws FROM documents)
    SELECT id, array_to_string(CASE WHEN lang IN ('de', 'en', 'es') THEN list_transform(ws, lambda x: left(x, 4)) ELSE ws END, ' ') AS stems FROM w""")
def _(spark, sf):
    docs = table(spark, sf, "documents", ["doc_id", "lang", "text"])
    stems = stem_tokens(F.split("text", " "), "lang", {code: _first_letters for code in ("de", "en", "es")})
    return docs.select(F.col("doc_id").alias("id"), F.array_join(stems, " ").alias("stems"))


def _letter_counter():
    """A deterministic encoder for the hook: how often some letters are in what the model reads."""
    return lambda texts: [[float(text.count(letter)) for letter in "eans"] for text in texts]


@query("encoder_hook", f"""
    WITH cut AS (SELECT doc_id AS id, {truncated_sql('text', 512)} AS text FROM documents),
    letters AS (SELECT * FROM (VALUES (0, 'e'), (1, 'a'), (2, 'n'), (3, 's')) v(pos, letter))
    SELECT id, pos::INTEGER AS pos, (length(text) - length(replace(text, letter, '')))::DOUBLE AS value FROM cut, letters""")
def _(spark, sf):
    docs = table(spark, sf, "documents", ["doc_id", "text"]).select(F.col("doc_id").alias("id"), "text")
    vectors = embed_column(docs, encoder=_letter_counter)
    return vectors.select("id", F.posexplode("embedding").alias("pos", "value")).withColumn("value", F.col("value").cast("double"))


@query("cv_prompts", f"""
    WITH eligible AS (
        SELECT doc_id AS id, text FROM documents JOIN nation ON n_nationkey = doc_id % 25
        WHERE doc_id % 30 >= 15 AND EXISTS (SELECT 1 FROM ({VALUES_SQL}) WHERE contains(lower('In ' || n_name), lower(value)))),
    {hashed_sql(f"SELECT id, {truncated_sql('text', 512)} AS text FROM eligible", 'id', 'text')},
    vectors AS (SELECT id, list(value ORDER BY pos) AS v FROM hashed GROUP BY id),
    {hashed_sql(f"SELECT item_id, {truncated_sql("'query: ' || text", 512)} AS text FROM benchmark", 'item_id', 'text', suffix='2')},
    asked AS (SELECT item_id AS query_id, list(value ORDER BY pos) AS q FROM hashed2 GROUP BY item_id),
    scored AS (SELECT query_id, id, round(list_cosine_similarity(v, q), 6)::DOUBLE AS score FROM vectors, asked WHERE list_max(v) > 0),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM scored),
    listed AS (
        SELECT n.query_id, string_agg('<' || n.id || '> ---' || d.text || '---', chr(10) ORDER BY n.rank) AS body
        FROM ranked n JOIN documents d ON d.doc_id = n.id WHERE rank <= 3 GROUP BY n.query_id)
    SELECT query_id, {_text_sql(default_match_instructions())} || chr(10) || chr(10) || '{CV_DELIMITER}' || b.text || '{CV_DELIMITER}'
        || chr(10) || chr(10) || '{POSTINGS_HEADING}' || chr(10) || chr(10) || body AS prompt
    FROM listed JOIN benchmark b ON b.item_id = query_id""")
def _(spark, sf):
    """The query side in one: recent postings of one country, the nearest to each CV, as prompts.

    A document lies in nation ``doc_id % 25`` and is ``29 - doc_id % 30`` days old; the
    dictionary of countries goes through its JSON file.
    """
    path = fresh_path(spark, "dictionary")
    country_dictionary(spark, sf).coalesce(1).write.text(path)
    values = country_values(read_country_dictionary(spark, path), "NATION_1")
    nation = table(spark, sf, "nation", ["n_nationkey", "n_name"])
    postings_ = table(spark, sf, "documents", ["doc_id", "text"]).join(nation, F.col("doc_id") % 25 == F.col("n_nationkey")).select(
        F.col("doc_id").alias("id"), F.col("text").alias("job_info"), F.concat(F.lit("In "), "n_name").alias("location"),
        F.expr("timestampadd(DAY, cast(doc_id % 30 AS INT), TIMESTAMP_NTZ '2024-01-01 00:00:00')").alias("timestamp"))
    cvs = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    embedded = embed_column(eligible_postings(postings_, "2024-01-30", values, literal=True), "job_info")
    return prompts_for_cvs(embedded, cvs, k=3)


_RANK_SQL = "CASE suitability " + " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(SUITABILITY, start=1)) + f" ELSE {len(SUITABILITY) + 1} END"


@query("match_results", f"""
    SELECT d.doc_id AS id, d.source AS title, d.lang AS location, l.suitability, 'quality ' || l.quality AS explanation,
        ({_RANK_SQL})::INTEGER AS category_rank
    FROM (SELECT *, CASE WHEN quality = 1 AND toxic = 0 THEN 'Highly Suitable' WHEN quality = 1 THEN 'Potentially Suitable'
        WHEN toxic = 0 THEN 'Marginally Suitable' ELSE 'Unheard Of' END AS suitability FROM labels) l
    JOIN documents d ON d.doc_id = l.doc_id""")
def _(spark, sf):
    """One JSON answer per label, joined back to the postings it judges."""
    suitability = (
        F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "Highly Suitable").when(F.col("quality") == 1, "Potentially Suitable")
        .when(F.col("toxic") == 0, "Marginally Suitable").otherwise("Unheard Of"))
    answers = table(spark, sf, "labels").select(F.to_json(F.array(F.struct(
        F.col("doc_id").alias("id"), suitability.alias("suitability"),
        F.concat(F.lit("quality "), F.col("quality").cast("string")).alias("explanation")))).alias("answer"))
    return match_results(answers, postings(spark, sf).select("id", "title", "location"))


@query("match_prompt", f"""
    WITH {NEAREST_DOCUMENTS_SQL},
    listed AS (
        SELECT n.query_id, string_agg('<' || n.id || '> ---' || d.text || '---', chr(10) ORDER BY n.rank) AS body
        FROM nearest n JOIN documents d ON d.doc_id = n.id GROUP BY n.query_id)
    SELECT query_id, {_text_sql(default_match_instructions())} || chr(10) || chr(10) || '{CV_DELIMITER}' || b.text || '{CV_DELIMITER}'
        || chr(10) || chr(10) || '{POSTINGS_HEADING}' || chr(10) || chr(10) || body AS prompt
    FROM listed JOIN benchmark b ON b.item_id = query_id""")
def _(spark, sf):
    cvs = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    return match_prompt(nearest_documents(spark, sf), docs, cvs)


# A summary form filled from the columns of a document; the text is the last section.
_TRIMMED = r"regexp_replace(text, '^\s+|\s+$', '', 'g')"


@query("split_summary_sections", f"""
    SELECT doc_id AS id, 0::INTEGER AS pos, 'Title' AS section, source AS value FROM documents
    UNION ALL SELECT doc_id, 1, 'Location', lang FROM documents
    UNION ALL SELECT doc_id, 2, 'Qualifications/Requirements', '' FROM documents
    UNION ALL SELECT doc_id, 3, 'About the company', {_TRIMMED} FROM documents""")
def _(spark, sf):
    summary = F.concat(
        F.lit("A preface\nTitle: "), "source", F.lit("\n\nLocation:\n"), "lang",
        F.lit("\nQualifications/Requirements:\nAbout the company: "), "text")
    return split_summary_sections(table(spark, sf, "documents").select(F.col("doc_id").alias("id"), summary.alias("summary")), JOB_SECTION_LABELS)


@query("split_cv_sections", f"""
    SELECT conv_id AS id, turn, 0::INTEGER AS pos, 'Skills' AS section, role AS value FROM conversations
    UNION ALL SELECT conv_id, turn, 1, 'Other Achivements', {_TRIMMED} FROM conversations""")
def _(spark, sf):
    summary = F.concat(F.lit("Skills: "), "role", F.lit("\nOther Achivements:\n"), "text")
    turns = table(spark, sf, "conversations").select(F.struct("conv_id", "turn").alias("key"), summary.alias("summary"))
    split = split_summary_sections(turns, CV_SECTION_LABELS, key="key")
    return split.select(F.col("key.conv_id").alias("id"), "key.turn", "pos", "section", "value")
