"""The queries of this subpackage over the test tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.session import configure, shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def prepare(spark: SparkSession) -> None:
    """Settings of the session that the operators rely on."""
    configure(spark)
    # Texts of any length go to Python: few rows at a time bound what a batch holds.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")


def _query(name: str, sql: str | None = None):
    def register(run):
        def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return run(spark, sf_dir)

        QUERIES[name] = configured
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query("op1_token_files")
def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents written as Simple-8b shards and read back."""
    import uuid

    import public_tokenizers

    from postlake.llm.token_files import read_documents, write_shards

    folder = f"{shared_dir(spark)}/tokens/{uuid.uuid4().hex}"
    path = public_tokenizers.path("word_bpe_49k.json")
    manifest = write_shards(table(spark, sf_dir, "documents"), folder, path, end_id=2)
    return read_documents(manifest, folder)


@_query("op3_simhash")
def simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and the components of those within 2 bits."""
    from postlake.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents")).drop("component")


@_query("op4_byte_bpe")
def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of all documents and of the bytes decoded from them."""
    import public_tokenizers

    from postlake.llm.byte_bpe import encode

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    tokens = encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, decoded="decoded")
    return tokens.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_query("op9_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents."""
    import public_tokenizers

    from postlake.llm.token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_TAKEN = "length(coalesce(text, '')) - length(translate(coalesce(text, ''), '{}', ''))"
_FEATURES_SQL = rf"""
docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {_WORDS} AS w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
wins AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM docs)),
reps AS (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM wins
  WHERE (r, g) IN (SELECT (r, g) FROM wins GROUP BY r, g HAVING count(*) > 1)),
cover AS (SELECT r, count(DISTINCT p) AS n FROM reps GROUP BY r),
base AS (SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
  {_TAKEN.format('#*$%&|<>')} AS n_symbols, {_TAKEN.format('ABCDEFGHIJKLMNOPQRSTUVWXYZ')} AS n_upper,
  {_TAKEN.format('0123456789')} AS n_digits, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
  coalesce(n, 0) AS n_repeat_words FROM docs LEFT JOIN cover USING (r))"""


@_query("op6_quality_rules", rf"""
WITH {_FEATURES_SQL}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR n_symbols * 4 > n_words OR n_upper * 10 > word_chars * 4
       OR n_digits * 2 > word_chars OR word_chars > n_words * 25 OR n_dup_lines * 2 > n_lines) AS kept
FROM base""")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base counts of all documents and the cascade's verdict."""
    from postlake.llm.quality import BASE_RULES, judge, rejected

    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    judged = judge(table(spark, sf_dir, "documents"), features=counts)
    failed = rejected(BASE_RULES[0], F.col("text"), counts) | rejected(BASE_RULES[1], F.col("text"), counts)
    return judged.select("doc_id", *counts, failed.alias("base_failed"), F.col("rejected_by").isNull().alias("kept"))


def _mixing_sql(rounds: int, step: int, tolerance: float, caps: int, keep: float, power: float) -> str:
    dims = ("source", "lang", "topic")
    steps = [rf"""WITH RECURSIVE docs AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, text,
  greatest(len({_WORDS}), 1) AS n_tokens FROM documents),
tagged AS (SELECT doc_id, source, lang, n_tokens, CASE WHEN {_TAKEN.format('#*$%&|<>')} > n_tokens / 4.0 THEN 'symbols'
  WHEN ({_TAKEN.format('ABCDEFGHIJKLMNOPQRSTUVWXYZ')}) * 10 > length(array_to_string({_WORDS}, '')) * 4 THEN 'capitals'
  WHEN n_tokens < 100 THEN 'note' WHEN n_tokens < 1000 THEN 'article' ELSE 'long' END AS topic FROM docs),
cells AS MATERIALIZED (SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS weight FROM tagged GROUP BY ALL)"""]
    for dim in dims:
        steps.append(f"""t_{dim} AS MATERIALIZED (SELECT {dim}, pow(sum(weight), {power}) / sum(pow(sum(weight), {power})) OVER () AS share
  FROM cells GROUP BY {dim})""")
    inner = f"SELECT * FROM fitted WHERE round < {rounds} AND (round % {step} <> 0 OR off > {tolerance})"
    for dim in dims:
        off = "abs(now - share)" if dim == dims[0] else "greatest(off, abs(now - share))"
        inner = f"""SELECT source, lang, topic, weight, rate * share / now AS rate, round, {off} AS off FROM
  (SELECT x.*, share, sum(weight * rate) OVER (PARTITION BY {dim}) AS now FROM ({inner}) x JOIN t_{dim} USING ({dim}))"""
    steps.append(f"""fitted AS (SELECT source, lang, topic, weight, 1.0::DOUBLE AS rate, 0 AS round, 'inf'::DOUBLE AS off FROM cells
  UNION ALL SELECT source, lang, topic, weight, rate, round + 1, max(off) OVER () FROM ({inner}))""")
    steps.append("rates AS MATERIALIZED (SELECT source, lang, topic, weight, rate FROM fitted WHERE round = (SELECT max(round) FROM fitted))")
    steps.append(f"k0 AS MATERIALIZED (SELECT {keep} * sum(weight) / sum(weight * rate) AS scale FROM rates)")
    for at in range(1, caps + 1):
        steps.append(f"""k{at} AS MATERIALIZED (SELECT greatest(max(scale), coalesce(({keep} * sum(weight) - sum(CASE WHEN rate * scale >= 1.0 THEN weight ELSE 0 END))
  / nullif(sum(CASE WHEN rate * scale >= 1.0 THEN 0.0 ELSE weight * rate END), 0), 0)) AS scale FROM rates, k{at - 1})""")
    return ",\n".join(steps) + f"""
SELECT doc_id, source, lang, topic, n_tokens, round(least(1.0, rate * scale), 9) AS probability,
  CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 12) AS BIGINT) / 281474976710656.0
    < least(1.0, rate * scale) AS kept
FROM tagged JOIN rates USING (source, lang, topic), k{caps}"""


@_query("op2_source_mixing", _mixing_sql(100, 4, 1e-6, 6, 0.5, 0.5))
def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability and draw of all documents, raked to square-root shares of source, language and topic."""
    from postlake.llm.mixing import mix

    mixed = mix(table(spark, sf_dir, "documents"), carry=("doc_id", "source", "lang"))
    return mixed.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("source"), F.coalesce("lang", F.lit("")).alias("lang"), "topic",
        "n_tokens", F.round("probability", 9).alias("probability"), "kept",
    )


@_query("op8_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents, from their texts, their pages' markup and hosts, or their own."""
    from postlake.llm.language import identify, page_evidence

    found = identify(table(spark, sf_dir, "documents"), page_evidence(table(spark, sf_dir, "pages")))
    return found.select("doc_id", "language", F.round("posterior", 6).alias("posterior"), "kept")


@_query("op5_toxicity")
def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents; labels of a fifth of the ids are never seen."""
    from postlake.llm.toxicity import fit, held_out, score

    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", "predicted")


@_query("op7_embedding_dedup")
def embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at a cosine of 0.9."""
    from postlake.llm.embeddings import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


TOOLS = {
    "search": {"query": ("string", True), "limit": ("integer", False)},
    "summarise": {"text": ("string", True), "brief": ("boolean", True)},
    "measure": {"of": ("string", True), "unit": ("string", True)},
}


def derived_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(calls, results) that turns of plain talk imply: an assistant's turn calls a tool on its text, and
    depends on the assistant's call before it but for every fourth; the user's next turn is its result.
    Lengths of texts decide which calls break their schema."""
    text, n = F.coalesce("text", F.lit("")), F.length(F.coalesce("text", F.lit("")))
    kind = F.pmod(F.col("conv_id") + F.col("turn"), F.lit(3))
    limit = F.when(n % 11 == 0, F.format_string('"%d"', n)).otherwise(n.cast("string"))
    quoted = F.expr("substring(to_json(named_struct('t', coalesce(text, ''))), 6)")  # the text as JSON and a brace
    arguments = (
        F.when(kind == 0, F.concat(F.lit('{"limit": '), limit, F.lit(', "query":'), quoted))
        .when(kind == 1, F.concat(F.when(n % 5 == 0, F.lit('{"text":')).otherwise(F.concat(F.lit('{"brief":'), (n % 2 == 0).cast("string"), F.lit(',"text":'))), quoted))
        .otherwise(F.concat(F.when(n % 7 == 0, F.lit('{"extra":null,')).otherwise(F.lit("{")), F.lit('"unit":"chars", "of":'), quoted))
    )
    name = F.when(kind == 0, "search").when(kind == 1, "summarise").otherwise("measure")

    def call(turn):
        return F.concat(F.lit("call_"), F.col("conv_id").cast("string"), F.lit("_"), turn.cast("string"))

    turn = F.col("turn")
    calls = conversations.where("role = 'assistant'").select(
        "conv_id", "turn", call(turn).alias("call_id"), name.alias("name"), arguments.alias("arguments"),
        F.when(F.floor(turn / 2) % 4 != 0, F.array(call(turn - 2))).otherwise(F.array().cast("array<string>")).alias("depends_on"),
    )
    results = conversations.where("role = 'user' AND turn > 0").select(
        "conv_id", "turn", call(turn - 1).alias("call_id"), text.alias("content")
    )
    return calls, results


@_query("op10_tool_calls", r"""
WITH RECURSIVE calls AS (SELECT conv_id, turn, 'call_' || conv_id || '_' || turn AS call_id, (conv_id + turn) % 3 AS k,
  coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
  CASE WHEN (turn // 2) % 4 <> 0 THEN 'call_' || conv_id || '_' || (turn - 2) END AS dep
  FROM conversations WHERE role = 'assistant'),
results AS (SELECT conv_id, turn, 'call_' || conv_id || '_' || (turn - 1) AS call_id, coalesce(text, '') AS content
  FROM conversations WHERE role = 'user' AND turn > 0),
nodes AS (SELECT conv_id, call_id, min(turn) AS first FROM calls GROUP BY ALL),
edges AS (SELECT DISTINCT c.conv_id, c.call_id, c.dep FROM calls c JOIN nodes d ON c.conv_id = d.conv_id AND c.dep = d.call_id),
depth AS (SELECT conv_id, call_id, 0 AS level FROM nodes UNION
  SELECT e.conv_id, e.call_id, level + 1 FROM depth d JOIN edges e ON e.conv_id = d.conv_id AND e.dep = d.call_id),
levels AS (SELECT conv_id, call_id, max(level) AS level FROM depth GROUP BY ALL),
answers AS (SELECT conv_id, call_id, min(struct_pack(turn := turn, content := content)) AS a FROM results GROUP BY ALL),
shaped AS (SELECT c.*, level, first, CASE WHEN c.turn <> first THEN 'repeated' WHEN a IS NULL THEN 'unanswered' ELSE 'linked' END AS status, a,
  ['search', 'summarise', 'measure'][k + 1] AS name,
  CASE k WHEN 0 THEN '{"limit":' || CASE WHEN n % 11 = 0 THEN '"' || n || '"' ELSE n::VARCHAR END || ',"query":' || to_json(t) || '}'
    WHEN 1 THEN CASE WHEN n % 5 = 0 THEN '{"text":' ELSE '{"brief":' || (n % 2 = 0) || ',"text":' END || to_json(t) || '}'
    ELSE CASE WHEN n % 7 = 0 THEN '{"extra":null,"of":' ELSE '{"of":' END || to_json(t) || ',"unit":"chars"}' END AS arguments,
  CASE k WHEN 0 THEN CASE WHEN n % 11 = 0 THEN 'limit is no integer' END WHEN 1 THEN CASE WHEN n % 5 = 0 THEN 'brief is missing' END
    ELSE CASE WHEN n % 7 = 0 THEN 'extra is unknown' END END AS error
  FROM calls c JOIN nodes USING (conv_id, call_id) JOIN levels USING (conv_id, call_id) LEFT JOIN answers USING (conv_id, call_id))
SELECT conv_id, turn, call_id, level::INT AS level, status, CASE WHEN error IS NULL THEN 0 ELSE 1 END::BIGINT AS n_errors,
  '{"arguments":' || arguments || CASE WHEN error IS NULL THEN '' ELSE ',"errors":["' || error || '"]' END || ',"id":"' || call_id || '","level":' || level
  || ',"name":"' || name || '"' || CASE WHEN status = 'linked' THEN ',"result":{"content":' || to_json(a.content) || ',"turn":' || a.turn || '}' ELSE '' END
  || ',"role":"assistant","status":"' || status || '","turn":' || turn || '}' AS json
FROM shaped
UNION ALL
SELECT conv_id, turn, call_id, NULL, 'orphan', 0, '{"content":' || to_json(content) || ',"id":"' || call_id || '","role":"tool","status":"orphan","turn":' || turn || '}'
FROM results r WHERE NOT EXISTS (SELECT 1 FROM nodes n WHERE n.conv_id = r.conv_id AND n.call_id = r.call_id)""")
def tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calls and results that all conversations imply: linked, ordered, validated, as canonical JSON."""
    from postlake.llm.tool_calls import link

    return link(*derived_calls(table(spark, sf_dir, "conversations")), TOOLS)


@_query("op12_sentencepiece")
def sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the SentencePiece ids of all documents and of the texts decoded from them."""
    import public_tokenizers

    from postlake.llm.marked_words import encode

    tokens = encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), decoded="decoded")
    return tokens.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@_query("op13_whitening")
def whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors whitened on their first eight components."""
    from postlake.llm.whitening import whiten

    rows = whiten(table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.col("deviation").try_cast("bigint"))


@_query("op11_collocations", r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (SELECT lang, k, list_aggregate(w[i:i + k - 1], 'string_agg', ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, range(1, 5) t(k) WHERE len(w) >= k)),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*)::HUGEINT AS c FROM grams GROUP BY ALL HAVING count(*) >= 30 OR k = 1),
sizes AS (SELECT lang, sum(c) AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS MATERIALIZED (SELECT lang, k, phrase, c AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cuts AS (SELECT p.lang, p.phrase, p.a, cut, h.c AS l, t.c AS r, 2000000 * p.a // (h.c + t.c) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM cand) p
  JOIN f h ON h.lang = p.lang AND h.phrase = array_to_string(p.w[1:cut], ' ')
  JOIN f t ON t.lang = p.lang AND t.phrase = array_to_string(p.w[cut + 1:], ' ')),
weakest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS o FROM cuts),
inside AS (SELECT lang, array_to_string(w[i:j], ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, k, w, a, i, unnest(range(i + 1, k + 1)) AS j FROM (SELECT *, unnest(range(1, k)) AS i FROM cand))
  WHERE j - i + 1 < k GROUP BY ALL),
kept AS (SELECT x.* FROM weakest x LEFT JOIN inside USING (lang, phrase) WHERE o = 1 AND coalesce(100 * longer < 80 * a, true)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000""")
def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of each language by their weakest cut, over all documents."""
    from postlake.llm.collocations import collocations

    return collocations(table(spark, sf_dir, "documents"))
