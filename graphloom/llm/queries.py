"""The registered queries of the numbered operators: each applies one to its whole table."""

from __future__ import annotations

import zlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm import byte_bpe, conversation_repair, decontaminate, hilbert_shards, jaccard_join, language_id, mixing, ngram_lm, periodic_runs, token_counts, token_files, topk_search, url_filter

URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), least=0.8)


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return topk_search.top_k(rows.where(F.col("vec_id") % 100 == 0), rows, k=10)


def op3_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards.shard_rows(table(spark, sf_dir, "documents"), shards=40)


def fold(key: str, parts: int):
    """Which of so many parts a document belongs to, from its id alone (a null id: the text ``null``)."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("null")).cast("binary")) % parts


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 3) == 1
    model = language_id.train(docs.where(~held_out))
    return language_id.predict(docs, model, [F.col("doc_id"), held_out.alias("held_out")]).drop("lang_mix")


def op5_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 10) == 0
    return ngram_lm.score(docs, ngram_lm.build(docs.where(~held_out)), [F.col("doc_id"), held_out.alias("held_out")])


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.encode_to_files(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), percent=80)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), rules)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), budget=0.5, topics=mixing.label_topics(table(spark, sf_dir, "labels")))
    return mixed.select("doc_id", "source", "lang", F.col("mix_topic").alias("topic"), F.col("mix_tokens").alias("n_tokens"), F.col("mix_probability").alias("probability"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def damaged(rows: DataFrame) -> DataFrame:
    """``conversations`` with a fault in one of four rows, by the checksum of id and turn: dropped, emptied, without sentence ends,
    repeated, or as a user's."""
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", known("conv_id"), known("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(known("text"), "[.!?]", "")).otherwise(known("text"))
    hit = rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(known("role")).alias("role"), text.alias("text"), kind.alias("kind")).where("kind <> 0")
    return hit.select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversation_repair.summaries(damaged(rows), every=rows)


def looped(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """One document in ten, by the checksum of its id, repeats a stretch of its words up to its end."""
    h = zlib.crc32(("null" if doc_id is None else str(doc_id)).encode())
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), prepare=looped)
    # Exponents compare as fractions; runs come by start and period, and the sort keeps the first of equal ones first.
    order = lambda a, b: F.coalesce(*[F.when(x != y, F.when(x < y, -1).otherwise(1)) for x, y in ((b.length * a.period, a.length * b.period), (a.start, b.start), (a.period, b.period))], F.lit(0))
    best = F.try_element_at(F.array_sort("runs", order), F.lit(1))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))), "")
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        digest(lines).alias("runs_sha256"), digest(F.col("collapsed")).alias("collapsed_sha256"),
    )


QUERIES = {f.__name__: f for f in (op1_decontaminate, op2_topk, op3_hilbert_shards, op4_language_id, op5_ngram_lm, op6_token_files, op7_token_counts, op8_jaccard_join, op9_url_filter, op10_mixing, op11_byte_bpe, op12_conversation_repair, op13_periodic_runs)}


def _hilbert_sql(bits: int = hilbert_shards.BITS) -> str:
    """The curve in plain SQL: one nested select for each step on an axis."""
    q = "SELECT id, size, text_crc32, source_code AS x0, lang_code AS x1, size_code AS x2 FROM coded"
    for b in range(bits - 1, 0, -1):
        m, p = 1 << b, (1 << b) - 1
        q = f"SELECT id, size, text_crc32, CASE WHEN x0 & {m} <> 0 THEN xor(x0, {p}) ELSE x0 END AS x0, x1, x2 FROM ({q})"
        for x in ("x1", "x2"):
            other = "x2" if x == "x1" else "x1"
            q = (
                f"SELECT id, size, text_crc32, CASE WHEN {x} & {m} <> 0 THEN xor(x0, {p}) ELSE xor(x0, xor(x0, {x}) & {p}) END AS x0, "
                f"CASE WHEN {x} & {m} <> 0 THEN {x} ELSE xor({x}, xor(x0, {x}) & {p}) END AS {x}, {other} FROM ({q})"
            )
    q = f"SELECT id, size, text_crc32, x0, xor(x0, x1) AS x1, xor(xor(x0, x1), x2) AS x2 FROM ({q})"
    flip = "0"
    for b in range(bits - 1, 0, -1):
        flip = f"xor({flip}, CASE WHEN x2 & {1 << b} <> 0 THEN {(1 << b) - 1} ELSE 0 END)"
    q = f"SELECT id, size, text_crc32, xor(x0, t) AS x0, xor(x1, t) AS x1, xor(x2, t) AS x2 FROM (SELECT *, {flip} AS t FROM ({q}))"
    bit = [f"((({x} >> {b}) & 1) << {3 * b + 2 - i})" for b in range(bits) for i, x in enumerate(("x0", "x1", "x2"))]
    return f"SELECT id, size, text_crc32, CAST({' + '.join(bit)} AS BIGINT) AS curve_index FROM ({q})"


def _mixing_sql(budget: float = 0.5, temperature: float = 0.5, rounds: int = mixing.ROUNDS) -> str:
    """Raking as a recursion over steps; each step scales one margin."""
    margins = ("source", "lang", "topic")

    def targets(m: str) -> str:
        return f"""
v_{m} AS (SELECT {m} AS v, sum(mass)::DOUBLE AS m, sum(sum(mass)) OVER () AS a FROM cells GROUP BY {m}),
w_{m} AS (SELECT *, pow(m / a, {temperature}) / sum(pow(m / a, {temperature})) OVER () AS w FROM v_{m}),
b_{m} AS (
  SELECT *, row_number() OVER o AS r, coalesce(sum(m) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS mb,
    1 - coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest
  FROM w_{m} WINDOW o AS (ORDER BY CASE WHEN w > 0 THEN m / w END NULLS LAST, v NULLS FIRST)),
l_{m} AS (SELECT min_by(({budget} * a - mb) / rest, r) AS level FROM b_{m} WHERE w > 0 AND rest > 0 AND ({budget} * a - mb) / rest * w <= m * (1 + 1e-12)),
t_{m} AS (SELECT v, coalesce(least(m, level * w), m) AS want, want >= m * (1 - 1e-9) AS full_ FROM b_{m}, l_{m})"""

    part = "CASE k % 3 " + " ".join(f"WHEN {i} THEN coalesce({m}, chr(1))" for i, m in enumerate(margins)) + " END"
    want = "CASE k % 3 " + " ".join(f"WHEN {i} THEN want_{m}" for i, m in enumerate(margins)) + " END"
    fixed = f"sum(CASE WHEN z >= mass THEN mass ELSE 0 END) OVER (PARTITION BY {part})"
    free = f"sum(CASE WHEN z < mass THEN z ELSE 0 END) OVER (PARTITION BY {part})"
    misses = [f"max(abs(y_{m} - want_{m})) OVER ()" for m in margins]
    worst = f"greatest({', '.join(misses)})"
    taken = ", ".join(f"sum(least(z, mass)) OVER (PARTITION BY {m}) AS y_{m}" for m in margins)
    return f"""
WITH RECURSIVE tokens AS (
  SELECT doc_id, source, lang, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens FROM documents),
topics AS (
  SELECT doc_id, 'quality ' || coalesce(max(quality)::VARCHAR, 'unknown') || ', toxic ' || coalesce(max(toxic)::VARCHAR, 'unknown') AS topic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS (SELECT tokens.*, coalesce(topic, 'unlabelled') AS topic FROM tokens LEFT JOIN topics USING (doc_id)),
cells AS (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS mass FROM d GROUP BY ALL),
{",".join(targets(m) for m in margins)},
x AS (
  SELECT 0 AS k, s.*, {", ".join(f"t_{m}.want AS want_{m}" for m in margins)}, s.mass * CASE WHEN {" OR ".join(f"t_{m}.full_" for m in margins)} THEN {mixing.OVER} ELSE {budget} END AS z
  FROM cells s {" ".join(f"JOIN t_{m} ON t_{m}.v IS NOT DISTINCT FROM s.{m}" for m in margins)}
  UNION ALL
  SELECT k + 1, source, lang, topic, mass, {", ".join(f"want_{m}" for m in margins)},
    least(z * CASE WHEN free > 0 AND want > fixed THEN (want - fixed) / free WHEN fixed + free > 0 THEN want / (fixed + free) ELSE 1 END, mass * {mixing.OVER})
  FROM (SELECT *, {want} AS want, {fixed} AS fixed, {free} AS free, {worst} AS worst FROM (SELECT *, {taken} FROM x WHERE k < {3 * rounds}))
  WHERE k = 0 OR k % {3 * mixing.PLAN_ROUNDS} > 0 OR worst > {mixing.TOLERANCE * budget} * (SELECT sum(mass) FROM cells)),
p AS (SELECT source, lang, topic, CASE WHEN mass > 0 THEN least(1.0, round(least(z, mass) / mass, {mixing.DECIMALS})) ELSE 1.0 END AS probability FROM x WHERE k = (SELECT max(k) FROM x))
SELECT d.doc_id, d.source, d.lang, d.topic, d.n_tokens, p.probability
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source AND d.lang IS NOT DISTINCT FROM p.lang AND d.topic IS NOT DISTINCT FROM p.topic
WHERE ('0x' || substr(md5('mix:' || coalesce(d.doc_id::VARCHAR, 'null')), 1, 8))::BIGINT / 4294967296.0 < p.probability
"""


#: DuckDB has no CRC-32: it is computed bit by bit over a 256-entry table made by rule, folded over the bytes of the text.
_CRC_TABLE_SQL = """
crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    WITH RECURSIVE s(i, k, c) AS (
      SELECT i, 0, i::BIGINT FROM range(256) r(i)
      UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM s WHERE k < 8
    ) SELECT i, c FROM s WHERE k = 8))"""
_CRC_OF_BYTES_SQL = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(bytes), 2), lambda p: ('0x' || substr(bytes, p, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, crc_table.t[(xor(c, b) & 255) + 1])), 4294967295)"""
_CRC_SQL = f"""{_CRC_TABLE_SQL},
spelled AS (SELECT *, hex(encode(coalesce(text, ''))) AS bytes FROM documents),
checked AS (SELECT d.*, {_CRC_OF_BYTES_SQL} AS text_crc32 FROM spelled d, crc_table)
"""

def _repair_sql() -> str:
    """The Viterbi as a recursion over rows that carries every place's cheapest edits as text, so ties compare whole texts."""
    blank = r"[^\x20\x09-\x0D]"
    return rf"""
WITH RECURSIVE {_CRC_TABLE_SQL},
spelled AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))) AS bytes FROM conversations),
kinds AS (SELECT spelled.*, {_CRC_OF_BYTES_SQL} % 20 AS kind FROM spelled, crc_table),
hit AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM kinds),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth, rank() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS early FROM hit),
faults AS (SELECT *, left(role, 1) AS i, CASE WHEN NOT regexp_matches(text, '{blank}') THEN 'b' WHEN nth > 1 THEN 'd' WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 't' ELSE '' END AS fault FROM seen),
placed AS (SELECT *, row_number() OVER o AS k, lag(i) OVER o AS before FROM faults WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, CASE WHEN fault = 'b' OR early > 1 THEN 0 ELSE 1 END, text, nth)),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (k > 1 AND before || i NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM placed GROUP BY conv_id),
inserts(place, ended, more, lines) AS (VALUES
  (0, 0, '', []), (0, 2, 'I', ['user:']), (0, 3, 'II', ['user:', 'assistant:']), (1, 1, '', []), (1, 2, 'I', ['user:']), (1, 3, 'II', ['user:', 'assistant:']),
  (2, 2, '', []), (2, 3, 'I', ['assistant:']), (2, 2, 'II', ['assistant:', 'user:']), (3, 3, '', []), (3, 2, 'I', ['user:']), (3, 3, 'II', ['user:', 'assistant:'])),
moves(place, ended, edit, i) AS (VALUES
  (0, 0, 'D', ''), (1, 1, 'D', ''), (2, 2, 'D', ''), (3, 3, 'D', ''), (0, 2, 'R', ''), (1, 2, 'R', ''), (2, 3, 'R', ''), (3, 2, 'R', ''),
  (0, 1, 'K', 's'), (0, 2, 'K', 'u'), (1, 2, 'K', 'u'), (2, 3, 'K', 'a'), (3, 2, 'K', 'u')),
walk(conv_id, k, place, cost, audit, lines) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, 0, 0, '', []::VARCHAR[] FROM conversations
  UNION ALL
  SELECT conv_id, k, place, cost, audit, lines FROM (
    SELECT w.conv_id, p.k, m.ended AS place, w.cost + 3 * length(x.more) + CASE m.edit WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END + CASE WHEN p.fault = 't' AND m.edit <> 'D' THEN 3 ELSE 0 END AS cost, w.audit || x.more || m.edit AS audit,
      w.lines || x.lines || CASE m.edit WHEN 'K' THEN [p.role || ':' || p.text] WHEN 'R' THEN [CASE m.ended WHEN 2 THEN 'user' ELSE 'assistant' END || ':' || p.text] ELSE [] END AS lines
    FROM walk w JOIN placed p ON p.conv_id IS NOT DISTINCT FROM w.conv_id AND p.k = w.k + 1 JOIN inserts x ON x.place = w.place
      JOIN moves m ON m.place = x.ended AND (m.edit <> 'K' OR m.i = p.i) AND (m.edit = 'D' OR p.fault NOT IN ('b', 'd')))
  QUALIFY row_number() OVER (PARTITION BY conv_id, place ORDER BY cost, audit) = 1),
ends AS (
  SELECT w.conv_id, w.cost + 3 * length(x.more) AS cost, w.audit || x.more AS audit, w.lines || x.lines AS lines
  FROM walk w LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id JOIN inserts x ON x.place = w.place AND x.ended IN (0, 3)
  WHERE w.k = coalesce(c.n, 0) QUALIFY row_number() OVER (PARTITION BY w.conv_id ORDER BY w.cost + 3 * length(x.more), w.audit || x.more) = 1)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost::BIGINT AS cost, audit,
  sha256(array_to_string(lines, chr(10))) AS repaired_sha256
FROM ends e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""


def _runs_sql() -> str:
    """Equal words of a document at every distance up to a third of it; neighbouring ones of one distance are a stretch."""
    return rf"""
WITH RECURSIVE {_CRC_TABLE_SQL},
spelled AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, hex(encode(coalesce(doc_id::VARCHAR, 'null'))) AS bytes FROM documents),
h AS (SELECT r, doc_id, w, len(w) AS n, {_CRC_OF_BYTES_SQL} AS h FROM spelled, crc_table),
a AS (SELECT *, (h // 10) % greatest(n, 1) AS a, 1 + (n - (h // 10) % greatest(n, 1)) // (3 + (h // 10) % 8) AS p FROM h),
d AS (SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) ELSE w END AS w FROM a),
x AS (SELECT r, n, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM d),
e AS (SELECT l.r, m.i - l.i AS q, l.i FROM x l JOIN x m ON l.r = m.r AND l.word = m.word AND m.i > l.i AND m.i - l.i <= l.n // 3),
g AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS g FROM e),
s AS (SELECT r, q, min(i) AS s, count(*) AS c FROM g GROUP BY r, q, g HAVING count(*) + q >= greatest(24, 3 * q)),
runs AS (SELECT r, s AS start, c + q AS length, min(q) AS period FROM s GROUP BY r, s, c + q),
best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY r ORDER BY length::DOUBLE / period DESC, start, period) = 1),
told AS (SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM runs GROUP BY r),
gone AS (SELECT DISTINCT x.r, x.i FROM x JOIN runs ON runs.r = x.r AND x.i >= start + period AND x.i < start + length),
kept AS (SELECT x.r, string_agg(word, ' ' ORDER BY x.i) AS text FROM x ANTI JOIN gone ON gone.r = x.r AND gone.i = x.i GROUP BY x.r)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM d LEFT JOIN told USING (r) LEFT JOIN best USING (r) LEFT JOIN kept USING (r)
"""


ORACLE_SQL = {
    "op8_jaccard_join": """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w] ELSE list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4]) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS overlap FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * overlap >= 80 * (x.n + y.n - overlap)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(node, low) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.low FROM r JOIN e ON e.a = r.node WHERE r.low < e.b)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(r.low) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN r ON r.node = d.doc_id GROUP BY ALL
""",
    "op10_mixing": _mixing_sql(),
    "op12_conversation_repair": _repair_sql(),
    "op13_periodic_runs": _runs_sql(),
    "op3_hilbert_shards": f"""
WITH {_CRC_SQL},
sized AS (SELECT doc_id AS id, source, lang, octet_length(encode(coalesce(text, ''))) + 16 AS size, text_crc32 FROM checked),
sources AS (SELECT source, floor((row_number() OVER (ORDER BY source NULLS FIRST) - 1) * 32 / count(*) OVER ())::BIGINT AS source_code FROM (SELECT DISTINCT source FROM documents)),
langs AS (SELECT lang, floor((row_number() OVER (ORDER BY lang NULLS FIRST) - 1) * 32 / count(*) OVER ())::BIGINT AS lang_code FROM (SELECT DISTINCT lang FROM documents)),
coded AS (
  SELECT id, size, text_crc32, source_code, lang_code,
    least(31, 2 * (length(bin(size)) - 5) + ((size >> (length(bin(size)) - 2)::BIGINT) & 1))::BIGINT AS size_code
  FROM sized s JOIN sources ON s.source IS NOT DISTINCT FROM sources.source JOIN langs ON s.lang IS NOT DISTINCT FROM langs.lang),
placed AS (
  SELECT *, row_number() OVER (ORDER BY curve_index, id NULLS FIRST, text_crc32) - 1 AS r, count(*) OVER () AS n FROM ({_hilbert_sql()})),
cut AS (SELECT *, (r * 40) // n AS s FROM placed)
SELECT id AS doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, s::INT AS shard,
  (row_number() OVER (PARTITION BY s ORDER BY r) - 1)::BIGINT AS slot, NULL::INT AS grown_shard, curve_index
FROM cut
""",
    "op2_topk": """
WITH w AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id, list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM w q JOIN w d ON q.vec_id % 100 = 0 AND q.vec_id <> d.vec_id)
SELECT query_id, rank::INT AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
""",
    "op9_url_filter": """
WITH p AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r(host, path, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
m AS (
  SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, r.verdict,
    row_number() OVER (PARTITION BY p.page_id, p.host, p.path ORDER BY length(r.host || r.path) DESC) AS k
  FROM p LEFT JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE k = 1
""",
}
