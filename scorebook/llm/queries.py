"""One registered query per operator, over its whole table, with its SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorebook.llm import chat, fill_middle, fingerprints, html_extract, language, line_dedup, mixing, near_dedup, negatives, packing, quality, secrets, url_filter
from scorebook.llm.common import table
from scorebook.plans.registry import Query

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_SPACES = r"[\x20\x09-\x0D]"


def query(sql: str | None = None):
    def register(build: Query) -> Query:
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql.strip()
        return build

    return register


@query()
def op1_html_min_cut(spark: SparkSession, folder: str) -> DataFrame:
    """Min-cut labelling per page; SQL cannot read markup."""
    return html_extract.main_text(table(spark, folder, "pages"))


@query(r"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')),
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, coalesce(role, '') = 'assistant' AS loss FROM c),
e AS (SELECT *, regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') AS body,
  regexp_replace(replace(replace(role, chr(92), chr(92) || chr(92)), chr(10), chr(92) || 'n'), '<(\\*)\|', '<\1\\|', 'g') AS head FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE loss), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE loss), '')) AS loss_sha256,
  sum(12 + length(head) + 1 + length(body) + 10 + 1)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
""")
def op2_reply_trees(spark: SparkSession, folder: str) -> DataFrame:
    control = f"{chat.END}{chat.START}assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], "conv_id long, turn long, role string, text string")
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.summary(chat.conversations(chat.chain(rows)))


@query(r"""
WITH RECURSIVE t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
q AS (SELECT *, CASE WHEN n > 1 THEN n - CASE WHEN n % 3 = 0 THEN 2 ELSE 1 END END AS parent, length(text) % 7 AS score FROM t),
l AS (SELECT conv_id, n FROM q WHERE (conv_id, n) NOT IN (SELECT conv_id, parent FROM q WHERE parent IS NOT NULL)),
p AS (SELECT conv_id, n AS leaf, n FROM l UNION ALL SELECT p.conv_id, p.leaf, q.parent FROM p JOIN q ON q.conv_id = p.conv_id AND q.n = p.n WHERE q.parent IS NOT NULL),
e AS (SELECT p.leaf, q.*, regexp_replace(q.text, '<(\\*)\|', '<\1\\|', 'g') AS body FROM p JOIN q ON q.conv_id = p.conv_id AND q.n = p.n),
b AS (SELECT conv_id, leaf, sum(score)::DOUBLE AS score, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  sum(12 + length(role) + 1 + length(body) + 10 + 1)::BIGINT AS formatted_chars FROM e GROUP BY conv_id, leaf),
r AS (SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY score DESC, leaf))::INTEGER AS branch FROM b)
SELECT conv_id, branch, score, n_turns, turns_sha256, formatted_chars FROM r WHERE branch <= 2
""")
def op2_branches(spark: SparkSession, folder: str) -> DataFrame:
    """Trees with real branches: each third message answers the one before the last; the two best branches of each tree."""
    linear = chat.chain(table(spark, folder, "conversations"))
    back = F.when(F.col("msg") % 3 == 0, 2).otherwise(1)
    trees = linear.withColumns({"parent": F.when(F.col("msg") > 1, F.col("msg") - back), "score": F.length(F.coalesce("text", F.lit(""))) % 7})
    formatted = chat.conversations(trees, per_tree=2)
    digests = chat.summary(formatted.withColumn("tree", F.struct("tree", "branch", "score")))
    return digests.select("conv_id.tree", "conv_id.branch", "conv_id.score", "n_turns", "turns_sha256", "formatted_chars").withColumnRenamed("tree", "conv_id")


@query(rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, doc_id, text, list_filter(string_split_regex(text, '{_SPACES}+'), lambda x: x <> '') AS w,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
m AS (SELECT rid, doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
  len(ls) AS n_lines, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(text, '[^!]', '', 'g')) AS n_shouts FROM w),
g AS (SELECT rid, unnest(range(1, len(w) - 1)) AS i, w FROM w WHERE len(w) >= 3),
t AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i], w[i + 1], w[i + 2]) AS n FROM g),
c AS (SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM t, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY rid),
a AS (SELECT m.*, coalesce(c.n_repeat_words, 0) AS n_repeat_words FROM m LEFT JOIN c ON m.rid = c.rid),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM a)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  failed::INTEGER AS failed, failed = 0 AS kept
FROM (SELECT *, (n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT + 8 * (100 * n_upper > 30 * word_chars)::INT
  + 16 * (10 * n_shouts > n_words)::INT + 32 * (100 * n_dup_lines > 50 * n_lines)::INT + 64 * (word_chars > 20 * n_words)::INT AS failed FROM b)
""")
def op5_quality_ledger(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.apply_policy(quality.ledger(table(spark, folder, "documents")))
    base = F.col("failed").bitwiseAND(F.lit(quality.mask("base"))) != 0
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "failed", "kept")


@query(f"""
WITH l AS ({ORACLES["op5_quality_ledger"].replace("SELECT doc_id, CAST(n_words", "SELECT CAST(n_words")}),
p AS (SELECT * FROM (VALUES ('base', 3), ('v1', 39), ('v2', 127)) AS p(policy, bits)),
r AS (SELECT * FROM (VALUES ('few_words', 1), ('repeated_words', 2), ('symbols', 4), ('upper_case', 8), ('shouting', 16), ('duplicate_lines', 32), ('long_words', 64)) AS r(rule, one))
SELECT policy, rule, count(*) FILTER (WHERE failed & one <> 0) AS failing, count(*) FILTER (WHERE failed & bits = one) AS alone,
  count(*) FILTER (WHERE failed & bits = 0) AS kept, count(*) FILTER (WHERE failed & (bits - one) = 0) AS kept_without,
  coalesce(bit_or(CASE WHEN failed & one <> 0 THEN failed & bits ELSE 0 END), 0)::INTEGER AS together
FROM p JOIN r ON bits & one <> 0, l GROUP BY policy, rule
""")
def op5_ablations(spark: SparkSession, folder: str) -> DataFrame:
    """What each rule of each policy decides, from the failure bits alone."""
    return quality.ablations(quality.ledger(table(spark, folder, "documents")))


@query(rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT rid, doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS i FROM d),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
h AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
j AS (SELECT k.*, h.top IS NOT NULL AND h.top <> k.doc_id AS dropped FROM k LEFT JOIN h ON k.key = h.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM j GROUP BY rid, doc_id
""")
def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    cut = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    lines = F.length(F.regexp_replace(F.coalesce("text", F.lit("")), "[^\n]+", "")) + 1
    return cut.select("doc_id", lines.cast("long").alias("n_lines"), "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query(rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_SPACES}+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT rid, doc_id, s FROM (
  SELECT rid, doc_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM (SELECT *, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)
  UNION ALL SELECT rid, doc_id, array_to_string(w, ' ') FROM d WHERE len(w) IN (1, 2))),
n AS (SELECT rid, doc_id, count(*) AS n FROM s GROUP BY rid, doc_id),
e AS (SELECT a.rid AS a, b.rid AS b FROM s a JOIN s b ON a.s = b.s AND a.rid <> b.rid
  JOIN n x ON x.rid = a.rid JOIN n y ON y.rid = b.rid GROUP BY a.rid, b.rid, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
r AS (SELECT rid AS a, rid AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(o.doc_id) AS component_id, d.doc_id = min(o.doc_id) AS kept
FROM d JOIN r ON r.a = d.rid JOIN d o ON o.rid = r.b LEFT JOIN n ON n.rid = d.rid GROUP BY d.rid, d.doc_id
""")
def op4_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"), width=3, percent=85).drop("mark", "component")


@query(rf"""
WITH d AS (SELECT doc_id, source, coalesce(length(doc_id::VARCHAR) || ':' || doc_id, '-') || ',' || coalesce(length(source) || ':' || source, '-') || ','
    || coalesce(length(text) || ':' || text, '-') AS k, len(list_filter(string_split_regex(coalesce(text, ''), '{_SPACES}+'), lambda x: x <> '')) AS size FROM documents),
i AS (SELECT md5(k) AS key, doc_id, source, size, count(*) AS times FROM d GROUP BY ALL),
s AS (SELECT source, sum(size * times)::BIGINT AS source_size FROM i GROUP BY source),
w AS (SELECT *, [3, 1, 2][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3] AS w, 2 * source_size AS cap FROM s),
v AS (SELECT *, (sum(source_size) OVER () * 150 / 100.0::DOUBLE - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level, row_number() OVER o AS place FROM w WINDOW o AS (ORDER BY cap / w, source IS NULL, source)),
c AS (SELECT arg_min(level, place) AS level FROM v WHERE level * w <= cap),
t AS (SELECT source, source_size, CASE WHEN c.level IS NULL OR c.level * w >= cap THEN cap::DOUBLE ELSE c.level * w END AS target FROM v LEFT JOIN c ON true),
r AS (SELECT i.*, t.source_size, t.target, row_number() OVER (PARTITION BY i.source ORDER BY size * times DESC, key) AS n,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS c,
    ('0x' || substr(md5('7:' || coalesce(i.source, 'null')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM i JOIN t ON i.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size::BIGINT AS size, source_size, target, size::BIGINT * (floor(c * n + u) - floor(c * (n - 1) + u))::BIGINT AS taken
FROM (SELECT *, unnest(range(times)) FROM r)
""")
def op7_systematic_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.copies(table(spark, folder, "documents"))
    rows = mixed.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query()
def op6_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """One row per piece; lengths in words. SQL has no greedy filling."""
    return packing.pack(table(spark, folder, "documents"))


@query()
def op8_learned_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Pattern matches and learned formats. SQL cannot fit the automata."""
    found = secrets.find_secrets(table(spark, folder, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(i).alias(f"n_{kind}") for i, kind in enumerate(secrets.KINDS[:3])],
        F.sha2(secrets.joined("base"), 256).alias("base_sha256"), secrets.joined("spans").alias("spans"),
    )


@query()
def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints and their likeness. SQL has no such hash; the edited texts are tested against it apart."""
    return fingerprints.fingerprint_edits(table(spark, folder, "documents"))


@query()
def op9_simhash_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """The partners that ``op9_simhash`` counts, as pairs of fingerprints; its rows say which documents have them."""
    return fingerprints.near_copies(table(spark, folder, "documents"))


#: The list history and fetch times of the query: every page is a capture, and gives one dated entry on its host, the
#: parent domain or a path prefix. 1704067200 is the first second of 2024.
_CAPTURE = "1704067200 + (page_id % 366) * 86400 + (page_id * 37) % 86400"
_LISTED = "1704067200 + (page_id * 11 % 366) * 86400 + (page_id * 53) % 86400"

_HOST = r"regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '\.+$', '')"
_PATH = r"list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^?#]*)', 1), '/'), lambda x: x <> '')"


@query(rf"""
WITH p AS (SELECT page_id, url, {_CAPTURE} AS ts, {_LISTED} AS listed, {_HOST} AS host, {_PATH} AS parts FROM pages),
q AS (SELECT *, string_split(host, '.') AS labels FROM p),
k AS (SELECT *, list_concat(list_transform(range(len(parts), 0, -1), lambda i: host || '/' || array_to_string(parts[1:i], '/')),
  list_transform(range(1, len(labels) + 1), lambda i: array_to_string(labels[i:], '.'))) AS keys FROM q WHERE host <> ''),
m AS (SELECT CASE page_id % 3 WHEN 0 THEN host WHEN 1 THEN array_to_string(labels[2:], '.') ELSE keys[1] END AS entry, listed AS ts,
  max(CASE page_id % 4 WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE 3 END) AS rank FROM k GROUP BY ALL),
v AS (SELECT *, lead(ts) OVER (PARTITION BY entry ORDER BY ts) AS upto FROM m),
x AS (SELECT page_id, ts, unnest(keys) AS entry, unnest(range(len(keys))) AS place FROM k),
f AS (SELECT x.page_id, arg_min(struct_pack(e := v.entry, r := v.rank, a := v.ts), x.place) AS b FROM x JOIN v
  ON v.entry = x.entry AND v.ts <= x.ts AND (v.upto IS NULL OR x.ts < v.upto) AND v.rank > 1 GROUP BY x.page_id)
SELECT p.page_id, p.url, p.ts AS fetched_at, CASE WHEN host <> '' THEN host END AS host, b.e AS entry,
  CASE b.r WHEN 2 THEN 'allow' WHEN 3 THEN 'block' END AS action, b.a AS listed_at, coalesce(b.r = 3, false) AS blocked
FROM p LEFT JOIN f ON p.page_id = f.page_id
""")
def op10_url_lists(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    keys, host = url_filter.entries_for(F.col("url")), url_filter.host_of(F.col("url"))
    turn, act = F.pmod("page_id", F.lit(3)), F.pmod("page_id", F.lit(4))
    labels = F.split(host, r"\.")
    parent = F.array_join(F.slice(labels, 2, F.size(labels)), ".")
    log = pages.select(
        F.when(turn == 0, host).when(turn == 1, parent).otherwise(F.get(keys, F.lit(0))).alias("entry"),
        F.when(act == 1, "allow").when(act == 2, "remove").otherwise("block").alias("action"), F.expr(_LISTED).alias("at"),
    )
    return url_filter.judge(pages.withColumn("fetched_at", F.expr(_CAPTURE)), log)


@query()
def op11_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Languages learned from the rows that are not held out. SQL has no compressor; held-out accuracy is tested."""
    docs = table(spark, folder, "documents")
    return language.identify(docs, language.learn(docs.filter(~language.held_out("doc_id"))))


@query(r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, 'null')) AS h FROM documents),
u AS (SELECT doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS lines, [('0x' || substr(h, 8 * i + 1, 8))::BIGINT for i in range(4)] AS h FROM d),
c AS (SELECT *, len(lines) AS n, least(h[1] % (len(lines) + 1), h[2] % (len(lines) + 1)) AS a, greatest(h[1] % (len(lines) + 1), h[2] % (len(lines) + 1)) AS b FROM u),
p AS (SELECT *, array_to_string(lines[1:a], '') AS pre, array_to_string(lines[a + 1:b], '') AS mid, array_to_string(lines[b + 1:], '') AS suf,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 100 THEN 'plain'
    WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
""")
def op12_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    restored = fill_middle.restore(fill_middle.fill_in_middle(table(spark, folder, "documents")))
    digest = lambda name: F.sha2(name, 256).alias(f"{name}_sha256")
    return restored.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest("output"), digest("restored"))


@query("""
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding AS v, row_number() OVER () AS r FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c AS (SELECT r, vec_id, label, unnest(v) AS x, unnest(range(len(v))) AS i FROM e),
q AS (SELECT r, vec_id, label, i, floor(256 * x::DOUBLE)::BIGINT AS x FROM c),
s AS (SELECT a.vec_id AS anchor_id, a.r AS ar, a.label AS al, b.vec_id, b.r, b.label, sum(a.x * b.x)::BIGINT AS score FROM q a JOIN q b ON a.i = b.i
  WHERE a.vec_id % 100 = 0 AND a.r <> b.r GROUP BY ALL),
p AS (SELECT ar, anchor_id, vec_id AS positive_id, r AS pr, score AS positive_score FROM s WHERE label = al
  QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id NULLS LAST, r) <= 5)
SELECT p.anchor_id, p.positive_id, (row_number() OVER w)::INTEGER AS rank, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.ar = p.ar AND s.label <> s.al AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
WINDOW w AS (PARTITION BY p.ar, p.pr ORDER BY s.score DESC, s.vec_id NULLS LAST, s.r) QUALIFY row_number() OVER w <= 10
""")
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", shifted))
