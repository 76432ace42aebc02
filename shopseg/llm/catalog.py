"""The registered ``opN_`` queries: each operator over whole ``documents``, and SQL for them where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

from shopseg.llm import (collocations, curriculum, decontaminate, divergence, language, linededup, minhash, packing, pii, shared,
                         sharding, simhash, token_ids, toxicity)


def op1_token_ids(spark, sf_dir):
    path = shared.shared_path(spark, "token-ids")
    token_ids.write_token_ids(shared.documents(spark, sf_dir), path)
    return token_ids.read_token_ids(spark, path)


def _fold(n):
    """crc32 of the id as text, modulo ``n``."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def op2_language(spark, sf_dir):
    docs = shared.documents(spark, sf_dir).select("doc_id", "text", "lang")
    held_out = F.coalesce(_fold(4) == 2, F.lit(False))
    out = language.identify(docs.drop("lang"), language.train(docs.where(~held_out)))
    return out.select("doc_id", held_out.alias("held_out"), F.col("__lang_pred").alias("lang_pred"),
                      F.col("__score").alias("score"), F.col("__rejected").alias("rejected"))


def op3_minhash(spark, sf_dir):
    out = minhash.compare_with_next(shared.documents(spark, sf_dir))
    return out.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})


def op4_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(shared.documents(spark, sf_dir), capacity=2048)


def op5_simhash(spark, sf_dir):
    out = simhash.near_duplicates(shared.documents(spark, sf_dir), shingle=4, distance=4)
    return out.select("doc_id", simhash.hex16("fp").alias("fingerprint"), "component_id")


def op6_sharding(spark, sf_dir):
    placed = sharding.shard_by_bytes(shared.documents(spark, sf_dir), shards=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op7_toxicity(spark, sf_dir):
    docs = shared.documents(spark, sf_dir).select("doc_id", "text")
    held_out = F.coalesce(_fold(5) == 0, F.lit(False))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.train(docs.where(~held_out), labels.where(~held_out))
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score",
                                              (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_decontamination(spark, sf_dir):
    out = decontaminate.contamination(shared.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


def op9_pii(spark, sf_dir):
    out = pii.find_spans(shared.documents(spark, sf_dir))
    counts = {f"n_{k}": F.expr(f"size(filter(spans, s -> s.kind = {i}))").cast("long") for i, k in enumerate(pii.KINDS) if k != pii.TERM}
    return out.select("doc_id", *(c.alias(k) for k, c in counts.items()),
                      F.sha2(pii.listed("spans", f"s.kind < {pii.KINDS.index(pii.TERM)}").cast("binary"), 256).alias("base_sha256"),
                      pii.listed("spans").alias("spans"))


def op10_line_dedup(spark, sf_dir):
    docs = shared.documents(spark, sf_dir).select("doc_id", "text")
    out = linededup.apply_bitmaps(docs, linededup.keep_bitmaps(docs, min_chars=10))
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"),
                      F.sha2(F.encode("__kept", "UTF-8"), 256).alias("kept_sha256"))


def op11_collocations(spark, sf_dir):
    return collocations.collocations(shared.documents(spark, sf_dir), least=30, longest=4, share=80, top=2000)


def op12_curriculum(spark, sf_dir):
    out = curriculum.mixed(shared.documents(spark, sf_dir), share=1.5, most=2)
    # documents that the mix never takes come first, at -1
    return out.na.fill(-1, ["at", "time"]).repartitionByRange("time", "at", "doc_id").sortWithinPartitions("time", "at", "doc_id")


def op13_divergence(spark, sf_dir):
    return divergence.audit(shared.documents(spark, sf_dir), least_docs=3, top=200)


#: A-Z lowered and nothing else.
SQL_LOWER = f"translate({{}}, '{shared.UPPER}', '{shared.LOWER}')"

SQL_LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line, {SQL_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key
  FROM lines),
firsts AS (
  SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT k.doc_id, pos, line, coalesce(k.doc_id > first, false) AS gone
  FROM keyed k LEFT JOIN firsts f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

SQL_DECONTAMINATION = f"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all({SQL_LOWER.format("text")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, len, array_to_string(w[s : s + len - 1], ' ') AS phrase FROM (
    SELECT item_id, w, least(10, len(w)) AS len, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS s
    FROM item_words WHERE len(w) > 0)),
doc_words AS (
  SELECT doc_id, regexp_extract_all(coalesce({SQL_LOWER.format("text")}, ''), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
spots AS (
  SELECT doc_id, w, len, unnest(generate_series(1, len(w) - len + 1)) AS s
  FROM doc_words, (SELECT DISTINCT len FROM windows) WHERE len(w) >= len),
hits AS (
  SELECT doc_id, s, spots.len, item_id FROM spots
  JOIN windows ON windows.len = spots.len AND windows.phrase = array_to_string(w[s : s + spots.len - 1], ' ')),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
    SELECT doc_id, unnest(generate_series(s, s + len - 1)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (
    SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN covered c ON d.doc_id = c.doc_id LEFT JOIN items i ON d.doc_id = i.doc_id
"""

SQL_COLLOCATIONS = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id,
         unnest(regexp_split_to_array({SQL_LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(w[s : s + k - 1], ' ') AS phrase FROM (
    SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS s
    FROM worded, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k)),
f AS (SELECT lang, k, phrase, CAST(count(*) AS HUGEINT) AS f FROM grams GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE k > 1 AND f >= 30),
cuts AS (SELECT lang, k, phrase, w, a, unnest(generate_series(1, k - 1)) AS j FROM candidates),
scored AS (
  SELECT c.lang, c.phrase, c.k, c.a, c.j, l.f AS l, r.f AS r, (2000000 * c.a) // (l.f + r.f) AS score FROM cuts c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1 : j], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[j + 1 : c.k], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inside AS (
  SELECT lang, array_to_string(w[s : s + m - 1], ' ') AS phrase, max(a) AS longer FROM (
    SELECT lang, w, a, m, unnest(generate_series(1, k - m + 1)) AS s FROM (
      SELECT lang, k, w, a, unnest(generate_series(2, k - 1)) AS m FROM candidates WHERE k > 2)) GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN inside i ON b.lang = i.lang AND b.phrase = i.phrase
  WHERE longer IS NULL OR 100 * longer < 80 * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT r.lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
       CAST(score AS BIGINT) AS score
FROM ranked r JOIN n ON r.lang = n.lang WHERE rank <= 2000
"""

SQL_CURRICULUM = """
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5(CAST(doc_id AS VARCHAR)) AS draw
  FROM documents),
sources AS (
  SELECT source, source_size, [5.0::DOUBLE, 2.0, 1.0][place % 3 + 1] AS weight, [7.5::DOUBLE, 2.0, 0.5][place % 3 + 1] AS w0,
         [-5.0::DOUBLE, 0.0, 1.0][place % 3 + 1] AS slope, place, 2 * source_size AS cap
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS place
        FROM sized GROUP BY source)),
filling AS (
  SELECT *, cap / weight AS full_at,
         ((SELECT sum(source_size) * 1.5::DOUBLE FROM sources) - coalesce(sum(cap) OVER before, 0))
         / ((SELECT sum(weight) FROM sources) - coalesce(sum(weight) OVER before, 0)) AS level
  FROM sources WINDOW before AS (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT level FROM filling WHERE level <= full_at ORDER BY full_at, place LIMIT 1),
targets AS (
  SELECT source, source_size, weight, w0, slope, least(CAST(cap AS DOUBLE), weight * coalesce((SELECT level FROM level), 'inf')) AS target
  FROM sources),
placed AS (
  SELECT s.*, t.* EXCLUDE (source), coalesce(sum(size) OVER (
    PARTITION BY s.source ORDER BY draw, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
copies AS (
  SELECT *, greatest(0, least(size, CAST(floor(target) AS BIGINT) - start - copy * source_size)) AS words
  FROM placed, (SELECT unnest([0, 1]) AS copy)),
demands AS (
  SELECT *, (CAST(start + copy * source_size AS DOUBLE) + words / 2.0::DOUBLE) / target * weight AS y FROM copies WHERE words > 0),
timed AS (
  SELECT *, least(1.0::DOUBLE, 2 * y / (w0 + sqrt(greatest(w0 * w0 + 2 * slope * y, 0.0::DOUBLE)))) AS time FROM demands),
numbered AS (SELECT *, row_number() OVER (ORDER BY time, draw, copy) - 1 AS at FROM timed)
SELECT p.doc_id, p.size, p.source_size, p.target,
       CAST((SELECT sum(words) FROM copies c WHERE c.doc_id = p.doc_id) AS BIGINT) AS taken,
       coalesce(n.time, -1.0::DOUBLE) AS time, coalesce(n.at, -1) AS at
FROM placed p LEFT JOIN numbered n ON n.doc_id = p.doc_id AND n.copy = 0
"""

SQL_DIVERGENCE = f"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({SQL_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
terms AS (SELECT lang, source, doc_id, unnest(w) AS term FROM docs),
kept AS (
  SELECT lang, term, CAST(count(*) AS HUGEINT) AS total FROM terms GROUP BY lang, term HAVING count(DISTINCT doc_id) >= 3),
langs AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
own AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS c FROM terms JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (
  SELECT g.lang, g.source, coalesce(v, 0) AS v, l.n AS n_lang, coalesce(s.n, 0) AS n
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN langs l ON g.lang = l.lang
  LEFT JOIN (SELECT lang, source, sum(c) AS n FROM own GROUP BY ALL) s ON g.lang = s.lang AND g.source = s.source),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c, 1 + (1000000000 * (coalesce(c, 0) + 1)) // (g.n + v) AS p,
         1 + (1000000000 * (total + 1)) // (n_lang + v) AS q
  FROM groups g JOIN kept k ON g.lang = k.lang LEFT JOIN own o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, (
    SELECT coalesce(sum(((x.p - y.p) * (x.p - y.p)) // y.p), 0) FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term
    WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source),
priced AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM p WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM priced)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
"""

QUERIES = {
    "op1_token_ids": op1_token_ids,
    "op2_language": op2_language,
    "op3_minhash": op3_minhash,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_simhash": op5_simhash,
    "op6_sharding": op6_sharding,
    "op7_toxicity": op7_toxicity,
    "op8_decontamination": op8_decontamination,
    "op9_pii": op9_pii,
    "op10_line_dedup": op10_line_dedup,
    "op11_collocations": op11_collocations,
    "op12_curriculum": op12_curriculum,
    "op13_divergence": op13_divergence,
}

ORACLE_SQL = {
    "op8_decontamination": SQL_DECONTAMINATION,
    "op10_line_dedup": SQL_LINE_DEDUP,
    "op11_collocations": SQL_COLLOCATIONS,
    "op12_curriculum": SQL_CURRICULUM,
    "op13_divergence": SQL_DIVERGENCE,
}
