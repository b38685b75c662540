"""The registered queries of this package and the SQL each is checked against."""
from pyspark.sql import functions as F

from mastgrid.llm import (
    bag_minhash, chat, decontaminate, line_dedup, mixing, pii, quality, ranked_search, secrets, suffix_dedup,
    token_align, token_count, token_shards,
)


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark, sf_dir):
    """Personal data of every text of ``documents``."""
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    spans = F.col("spans")
    return found.select(
        "doc_id",
        *[pii.count_kind(spans, kind).alias(f"n_{kind}") for kind in pii.BASE],
        F.sha2(pii.joined(pii.base_spans(spans)), 256).alias("base_sha256"),
        pii.joined(spans).alias("spans"),
        *[pii.count_kind(spans, kind).alias(f"n_{kind}") for kind in pii.PATTERNS if kind not in pii.BASE],
        pii.scores(spans).alias("scores"),
    )


def op7_quality(spark, sf_dir):
    """The rule ledger of every text of ``documents`` under the current policy."""
    rows = quality.ledger(table(spark, sf_dir, "documents"))
    base = F.lit(quality.mask_of(quality.BASE)).cast("long")
    return rows.select(
        "doc_id", *quality.MEASURES[:5],
        (F.col("fail_bits").bitwiseAND(base) != 0).alias("base_failed"),
        quality.passes().alias("kept"),
        "n_lines", "n_capitals", "fail_bits",
    )


def op2_decontaminate(spark, sf_dir):
    """Benchmark passages in every text of ``documents``."""
    found = decontaminate.find_passages(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = decontaminate.n_hit()
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"))


def op3_line_dedup(spark, sf_dir):
    """What line removal does to every text of ``documents``."""
    rows = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_removed", "n_spans",
                       F.sha2("text", 256).alias("kept_sha256"))


def op5_chat(spark, sf_dir):
    """The maximal conversations of ``conversations``, rendered."""
    return chat.render(table(spark, sf_dir, "conversations"))


def op6_mixing(spark, sf_dir):
    """How often each row of ``documents`` is used under the default mixture."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "copies", "weight_ppm")


def op4_near_dedup(spark, sf_dir):
    """The near-duplicate class of every row of ``documents``."""
    return bag_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_suffix_dedup(spark, sf_dir):
    """What the removal of repeated 100-byte strings does to every text of ``documents``."""
    rows = suffix_dedup.dedup_substrings(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans",
                       F.sha2("kept", 256).alias("kept_sha256"))


def op9_token_count(spark, sf_dir):
    """Token counts of every text of ``documents``."""
    counted = token_count.count_tokens(table(spark, sf_dir, "documents"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 4096)


def op10_token_shards(spark, sf_dir):
    """Every token sequence of ``documents`` at its place in the training order."""
    return token_shards.training_order(table(spark, sf_dir, "documents"))


def op11_secrets(spark, sf_dir):
    """Secrets of every text of ``documents``."""
    spans = F.col("spans")
    return secrets.find_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id", *[secrets.count_kind(spans, kind).alias(f"n_{kind}") for kind in secrets.BASE],
        F.sha2(secrets.joined(secrets.base_spans(spans)), 256).alias("base_sha256"),
        secrets.joined(spans).alias("spans"))


def op12_search(spark, sf_dir):
    """The documents that match each item of ``benchmark`` best."""
    return ranked_search.search(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_align(spark, sf_dir):
    """How the tokens of two tokenizers line up in every text of ``documents``."""
    found = token_align.align(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *token_align.COUNTS, "n_best", "count_sum",
        F.coalesce(F.sha2("groups", 256), F.lit("")).alias("groups_sha256"))


QUERIES = {
    "op2_decontaminate": op2_decontaminate,
    "op3_line_dedup": op3_line_dedup,
    "op4_near_dedup": op4_near_dedup,
    "op5_chat": op5_chat,
    "op6_mixing": op6_mixing,
    "op1_pii": op1_pii,
    "op7_quality": op7_quality,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_token_count": op9_token_count,
    "op10_token_shards": op10_token_shards,
    "op11_secrets": op11_secrets,
    "op12_search": op12_search,
    "op13_align": op13_align,
}

SPACE = "[\\x20\\x09-\\x0D]"
QUALITY_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM d
), windows AS (
  SELECT doc_id, i, words[i:i+2] AS key FROM (
    SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), twice AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, key) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT j) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM twice) GROUP BY doc_id
), m AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '{SPACE}', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS BIGINT) AS n_capitals
  FROM w LEFT JOIN covered USING (doc_id)
), bits AS (
  SELECT *, CAST(
      CASE WHEN n_words < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
    + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
    + CASE WHEN 10 * n_capitals > 3 * word_chars THEN 16 ELSE 0 END
    + CASE WHEN word_chars > 15 * n_words THEN 32 ELSE 0 END AS BIGINT) AS fail_bits
  FROM m
)
"""

MIXING_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(source, '') AS s,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n,
    CAST('0x' || substr(md5('{mixing.SEED}:' || doc_id), 1, 15) AS BIGINT) AS key
  FROM documents
), totals AS (
  SELECT s, CAST(sum(n) AS DOUBLE) AS n FROM d GROUP BY s HAVING sum(n) > 0
), shares AS (
  SELECT s, n, n / (SELECT sum(n) FROM totals) AS p FROM totals
), flat AS (
  SELECT list(p ORDER BY s) AS p, max(p) / min(p) AS spread, ln(count(*)) AS equal FROM shares
), halved AS (
  SELECT 0 AS step, 0e0 AS lo, 1e0 AS hi, 0e0 AS lo2, 1e0 AS hi2
  UNION ALL
  SELECT step + 1, CASE WHEN fits THEN (lo + hi) / 2 ELSE lo END,
    CASE WHEN fits THEN hi ELSE (lo + hi) / 2 END, CASE WHEN few THEN (lo2 + hi2) / 2 ELSE lo2 END,
    CASE WHEN few THEN hi2 ELSE (lo2 + hi2) / 2 END
  FROM (SELECT *, pow(spread, (lo2 + hi2) / 2) <= {mixing.MAX_REPEATS} AS few,
      ln(list_sum(list_transform(p, lambda x: pow(x, (lo + hi) / 2))))
        - list_sum(list_transform(p, lambda x: pow(x, (lo + hi) / 2) * ln(pow(x, (lo + hi) / 2))))
        / list_sum(list_transform(p, lambda x: pow(x, (lo + hi) / 2)))
        >= {mixing.TARGET_ENTROPY} * equal AS fits
    FROM halved, flat WHERE step < {mixing.STEPS})
), alpha AS (
  SELECT greatest(CASE WHEN ln(list_sum(p)) - list_sum(list_transform(p, lambda x: x * ln(x)))
      / list_sum(p) >= {mixing.TARGET_ENTROPY} * equal THEN 1e0 ELSE lo END,
    CASE WHEN spread <= {mixing.MAX_REPEATS} THEN 0e0 ELSE 1 - lo2 END) AS a
  FROM halved, flat WHERE step = {mixing.STEPS}
), weights AS (
  SELECT s, n, greatest(1, round(pow(p, a) / (SELECT sum(pow(p, a)) FROM shares, alpha) * 1e6)) AS w
  FROM shares, alpha
), plan AS (
  SELECT s, n, w, greatest(n, floor((SELECT max(ceil(n * 1e6 / w)) FROM weights) * w / 1e6)) AS target
  FROM weights
), upto AS (
  SELECT d.*, w, floor(target / plan.n) AS passes, target % plan.n AS rest,
    sum(d.n) OVER (PARTITION BY s ORDER BY key RANGE UNBOUNDED PRECEDING) AS upto
  FROM d LEFT JOIN plan USING (s)
)
SELECT doc_id, source,
  CAST(coalesce(passes + CASE WHEN upto <= rest THEN 1 ELSE 0 END, 1) AS BIGINT) AS copies,
  CAST(coalesce(w, 0) AS BIGINT) AS weight_ppm FROM upto"""

def _any_case(word):
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


ASSIGNED = "[\"'']?\\x20*[:=]\\x20*[\"'']?"
SECRET_NAMES = "|".join(map(_any_case, ("password", "passwd", "secret", "token", "api_?key")))
KEY_NAMES = "|".join(map(_any_case, ("key", "pwd", "passphrase", "credential")))
CLIENT_NAMES = "|".join(map(_any_case, (
    "key_?id", "client_?id", "account_?id", "user_?name", "user", "login")))
SCHEMES = "|".join(map(_any_case, (
    "https?", "ftp", "s3", "jdbc:[a-z0-9]+", "postgresql", "mysql", "mongodb", "redis", "amqp"))
    ).replace("[[aA]-[zZ]0-9]", "[a-zA-Z0-9]")
#: kind, role, whether it is weak, pattern, check of the match m.
SECRET_KINDS = [
    ("assign", "secret", False, f"(?:{SECRET_NAMES}){ASSIGNED}([A-Za-z0-9+/_.=-]+)",
     "length(regexp_extract(m, pattern, 1)) >= 6"),
    ("access", "identifier", False, "AKIA[A-Z0-9]+", "length(m) >= 20"),
    ("hex", "", False, "[0-9a-f]+", "length(m) >= 24"),
    ("key", "secret", True, f"(?:{KEY_NAMES}){ASSIGNED}([A-Za-z0-9+/_.=-]+)",
     "length(regexp_extract(m, pattern, 1)) >= 8"),
    ("blob", "secret", True, "[A-Za-z0-9+/]+", """length(m) = 40 AND regexp_matches(m, '[A-Z]')
       AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[0-9]')"""),
    ("client", "identifier", True, f"(?:{CLIENT_NAMES}){ASSIGNED}([A-Za-z0-9@_.-]+)",
     "length(regexp_extract(m, pattern, 1)) >= 3"),
    ("endpoint", "endpoint", True, f"(?:{SCHEMES})://[^\\x00-\\x20\"''<>]+", "true"),
    ("break", "", False, "\\n[\\x20\\t\\r]*\\n", "true"),
]


def _located_sql(place, kind, role, weak, pattern, check):
    check = check.replace("pattern", f"'{pattern}'")
    return f"""SELECT doc_id, row, {place} AS place, '{kind}' AS kind, '{role}' AS role, {weak} AS weak,
      s, s + length(m) AS e FROM (
        SELECT doc_id, row, m, CAST(sum(length(g) + length(m)) OVER (PARTITION BY row ORDER BY i)
          - length(m) AS BIGINT) AS s
        FROM (SELECT doc_id, row, unnest(f) AS m, unnest(g[:len(f)]) AS g, generate_subscripts(f, 1) AS i
          FROM (SELECT doc_id, row, regexp_extract_all(text, '{pattern}') AS f,
            regexp_split_to_array(text, '{pattern}') AS g FROM d))) WHERE {check}"""


SECRETS_SQL = f"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS row, coalesce(text, '') AS text FROM documents
), parts AS (
  {' UNION ALL '.join(_located_sql(i, *kind) for i, kind in enumerate(SECRET_KINDS))}
), near AS (
  SELECT DISTINCT w.row, w.place, w.kind, w.s, w.e FROM parts w JOIN parts p USING (row)
  WHERE w.weak AND p.role <> '' AND w.role <> p.role AND 'secret' IN (w.role, p.role)
    AND greatest(w.s - p.e, p.s - w.e) <= {secrets.REACH}
    AND NOT EXISTS (SELECT 1 FROM parts b WHERE b.row = w.row AND b.kind = 'break'
      AND b.s >= least(w.s, p.s) AND b.e <= greatest(w.e, p.e))
    AND NOT EXISTS (SELECT 1 FROM parts b WHERE b.row = w.row AND b.kind IN ('assign', 'access', 'hex')
      AND b.s < w.e AND w.s < b.e)
), spans AS (
  SELECT row, place, kind, s, e FROM near
  UNION ALL SELECT row, place, kind, s, e FROM parts WHERE NOT weak AND kind <> 'break'
), said AS (
  SELECT row, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place) AS spans,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place) FILTER (place < 3) AS base,
    count(*) FILTER (place = 0) AS n_assign, count(*) FILTER (place = 1) AS n_access,
    count(*) FILTER (place = 2) AS n_hex
  FROM spans GROUP BY row
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN said USING (row)"""

SEARCH_SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
), sizes AS (
  SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS total FROM d WHERE len(w) > 0
), tf AS (
  SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d
), counts AS (
  SELECT doc_id, n, term, CAST(count(*) AS BIGINT) AS tf FROM tf GROUP BY ALL
), terms AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2e0 * n_docs + 2) / (2e0 * count(*) + 1))) AS BIGINT) AS weight
  FROM counts, sizes GROUP BY term, n_docs
), scores AS (
  SELECT item_id, doc_id, CAST(sum(weight * ((1000000000 * tf)
    // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // total)))) AS BIGINT) AS score
  FROM terms JOIN counts USING (term) JOIN weights USING (term), sizes GROUP BY item_id, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank,
  doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 50"""

ORACLES = {
    "op12_search": SEARCH_SQL,
    "op11_secrets": SECRETS_SQL,
    "op7_quality": QUALITY_SQL + """SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines,
      n_repeat_words, fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept, n_lines,
      n_capitals, fail_bits FROM bits""",
    "op2_decontaminate": """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
), patterns AS (
  SELECT DISTINCT item_id, w[i:i + least(10, len(w)) - 1] AS key FROM (
    SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)
), sizes AS (
  SELECT DISTINCT len(key) AS n FROM patterns
), places AS (
  SELECT doc_id, i, n, w[i:i + n - 1] AS key FROM (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes)
), hits AS (
  SELECT doc_id, i, n, item_id FROM places JOIN patterns USING (key)
), words AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM (
    SELECT doc_id, unnest(range(i, i + n)) AS j FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM hits GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op3_line_dedup": """
WITH d AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), w AS (
  SELECT doc_id, i, lines[i:i+2] AS key FROM (
    SELECT doc_id, lines, unnest(range(1, len(lines) - 1)) AS i FROM d)
), later AS (
  SELECT doc_id, i FROM w
  QUALIFY row_number() OVER (PARTITION BY key ORDER BY doc_id, i) > 1
), covered AS (
  SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS line FROM later
), numbered AS (
  SELECT doc_id, unnest(lines) AS said, generate_subscripts(lines, 1) AS line FROM d
), marked AS (
  SELECT n.*, c.line IS NOT NULL AS gone FROM numbered n LEFT JOIN covered c USING (doc_id, line)
), spans AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY line), false) AS begins
  FROM marked
)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_removed,
  CAST(count(*) FILTER (begins) AS BIGINT) AS n_spans,
  sha256(coalesce(string_agg(said, chr(10) ORDER BY line) FILTER (NOT gone), '')) AS kept_sha256
FROM spans GROUP BY doc_id""",
    "op5_chat": """
WITH t AS (
  SELECT conv_id, role, text, CAST(row_number() OVER w AS INT) AS pos,
    list({'role': role, 'text': text}) OVER w AS said
  FROM conversations
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST
    ROWS UNBOUNDED PRECEDING)
), n AS (
  SELECT *, count(*) OVER (PARTITION BY conv_id) AS n FROM t
), whole AS (
  SELECT said, min(conv_id) AS conv_id, count(*) AS n_logs FROM n WHERE pos = n GROUP BY said
), kept AS (
  SELECT * FROM whole WHERE NOT EXISTS (
    SELECT 1 FROM n WHERE n.pos < n.n AND n.said = whole.said)
)
SELECT conv_id, CAST(len(said) AS BIGINT) AS n_turns, CAST(n_logs AS BIGINT) AS n_logs,
  array_to_string(list_transform(said, lambda x: '<|im_start|>' || coalesce(x.role, 'unknown')
    || chr(10) || coalesce(x.text, '') || '<|im_end|>' || chr(10)), '') AS text
FROM kept""",
    "op6_mixing": MIXING_SQL,
}
