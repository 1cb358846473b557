"""The registered query of each operator over its whole table, and DuckDB statements where SQL can state the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import bpe, decontaminate, html, lines, minhash, passages, quality, sharding, spelling, tokenfiles, trie, unigram, urls

WORD = r"[^\x20\x09-\x0D]+"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = lines.remove_repeated_lines(_table(spark, folder, "documents"))
    return found.select("doc_id", "text", "n_lines", "n_removed_lines")


_OP1 = """
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
m AS (SELECT *, ('0x' || substr(md5(line), 1, 7))::BIGINT AS mark FROM l),
r AS (SELECT *, lag(mark, 1) OVER w + 31 * lag(mark, 2) OVER w AS r, count(*) OVER (PARTITION BY doc_id) AS n,
    i % 2 = 1 AND line = lag(line, 1) OVER w AND line = lag(line, 2) OVER w AND line = lag(line, 3) OVER w AND line = lead(line) OVER w AS run
    FROM m WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
o AS (SELECT *, i = 1 OR (i BETWEEN 3 AND n - 1 AND ((coalesce(r < lag(r) OVER w, true) AND r < lead(r) OVER w) OR coalesce(run, false))) AS opens
    FROM r WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
c AS (SELECT *, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM o),
b AS (SELECT doc_id, k, count(*) AS lines, string_agg(line, chr(10) ORDER BY i) AS body FROM c GROUP BY 1, 2),
f AS (SELECT *, lines > 1 AND row_number() OVER (PARTITION BY body ORDER BY doc_id, k) > 1 AS gone FROM b)
SELECT d.doc_id, CASE WHEN any_value(d.text) IS NOT NULL THEN coalesce(string_agg(body, chr(10) ORDER BY k) FILTER (NOT gone), '') END AS text,
    coalesce(sum(lines), 0)::BIGINT AS n_lines, coalesce(sum(lines) FILTER (gone), 0)::BIGINT AS n_removed_lines
FROM documents d LEFT JOIN f USING (doc_id) GROUP BY 1
"""


def op2_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = minhash.near_duplicates(_table(spark, folder, "documents"), width=4)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


_OP2 = rf"""
WITH RECURSIVE
w AS (SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}'), []) AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM w),
e AS (SELECT doc_id, unnest(s) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN s sa ON sa.doc_id = a JOIN s sb ON sb.doc_id = b WHERE 100 * n >= 80 * (len(sa.s) + len(sb.s) - n)),
g AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS other FROM s UNION SELECT r.doc_id, g.b FROM r JOIN g ON g.a = r.other),
c AS (SELECT doc_id, min(other) AS component_id FROM r GROUP BY 1)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN c USING (doc_id)
"""

def op3_sampled_splitters(spark: SparkSession, folder: str) -> DataFrame:
    found = sharding.shard_by_bytes(_table(spark, folder, "documents"))
    return found.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))


_OP3 = """
WITH r AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS (SELECT doc_id, (octet_length(encode(t)) + 1)::BIGINT AS size, md5(t) AS digest,
    list_transform(regexp_extract_all(hex(t), '..'), lambda h: ('0x' || h)::BIGINT) AS bytes FROM r),
c AS (SELECT doc_id, size, digest, xor(list_reduce(
    flatten(list_transform(bytes, lambda b: [b & 1, (b >> 1) & 1, (b >> 2) & 1, (b >> 3) & 1, (b >> 4) & 1, (b >> 5) & 1, (b >> 6) & 1, (b >> 7) & 1])),
    lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)), 4294967295), 4294967295)::BIGINT AS text_crc32 FROM s),
o AS (SELECT *, sum(size) OVER w - size AS before, sum(size) OVER () AS total FROM c
    WINDOW w AS (ORDER BY digest, doc_id ROWS UNBOUNDED PRECEDING)),
p AS (SELECT *, (before * 8 // total)::INT AS shard FROM o)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, (row_number() OVER (PARTITION BY shard ORDER BY digest, doc_id) - 1)::BIGINT AS slot,
    NULL::INT AS grown_shard FROM p
"""

RULES = (
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))


def op4_host_reputation(spark: SparkSession, folder: str) -> DataFrame:
    """A page's outcome is the label of the document that the number in its path names: bad if poor or toxic."""
    pages, labels = _table(spark, folder, "pages"), _table(spark, folder, "labels")
    path = urls.path_of(F.col("url"))
    named = pages.select(
        urls.host_of(F.col("url")).alias("host"),
        F.regexp_extract(path, r"/([0-9]{1,18})(?:\.html)?/?$", 1).try_cast("bigint").alias("doc_id"))
    bad = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    outcomes = named.where("doc_id is not null").join(bad, "doc_id").select("host", "bad")
    return urls.judge(pages, outcomes, RULES).select("page_id", "host", "path", "rule", "verdict")


def _op4_level(unit: str, parent: str, prior: str) -> str:
    return f"""
{unit}_k AS (SELECT CASE WHEN coalesce(under, 0) = 0 OR coalesce(over_, 0) <= 0 THEN 10000.0 ELSE least(greatest(under / over_ - 1, 1.0), 10000.0) END AS k
    FROM (SELECT sum((bad - n * mean) ** 2 - n * mean * (1 - mean)) AS over_, sum(n * (n - 1) * mean * (1 - mean)) AS under FROM {parent})),
{unit}_m AS (SELECT * EXCLUDE (mean), (k * mean + bad) / (k + n) AS mean FROM {parent}, {unit}_k){prior}"""


_OP4 = rf"""
WITH p AS (SELECT page_id, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
l AS (SELECT doc_id, max((quality = 0 OR toxic = 1)::INT) AS bad FROM labels GROUP BY 1),
o AS (SELECT host, count(*) AS n, sum(bad) AS bad FROM p JOIN l ON doc_id = try_cast(regexp_extract(path, '/([0-9]{{1,18}})(?:\.html)?/?$', 1) AS BIGINT) GROUP BY 1),
h AS (SELECT host, coalesce(n, 0) AS n, coalesce(bad, 0) AS bad, array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS domain,
    string_split(host, '.')[-1] AS suffix FROM (SELECT DISTINCT host FROM p) LEFT JOIN o USING (host)),
d AS (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY 1, 2),
s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, any_value(g) AS mean FROM d, (SELECT (sum(bad) + 0.5) / (sum(n) + 1.0) AS g FROM h) GROUP BY 1),
{_op4_level("s", "s", ",")}
dm AS (SELECT d.*, mean FROM d JOIN s_m USING (suffix)),
{_op4_level("d", "dm", ",")}
hm AS (SELECT h.*, mean FROM h JOIN d_m USING (domain)),
{_op4_level("h", "hm", ",")}
b AS (SELECT host, mean - 1.645 * sqrt(mean * (1 - mean) / (k + n + 1)) > 0.5 AS block FROM h_m),
r AS (SELECT * FROM (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')) AS r(verdict, rh, rp)),
f AS (SELECT page_id, rh || rp AS rule, verdict FROM p JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
    QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC) = 1)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN block THEN 'block' ELSE 'allow' END) AS verdict
FROM p JOIN b USING (host) LEFT JOIN f USING (page_id)
"""


def op5_count_viterbi(spark: SparkSession, folder: str) -> DataFrame:
    found = unigram.count_tokens(_table(spark, folder, "documents"), _tokenizer("piece_bpe_32k.model"))
    return found.select("doc_id", "n_tokens")


def op6_simhash_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "start", "n_words", F.round("similarity", 6).alias("similarity"))


_OP6 = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM benchmark),
e AS (SELECT doc_id, len(w) AS words, unnest(range(len(w) - 4)) AS pos, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS x FROM w WHERE len(w) > 4),
i AS (SELECT item_id, any_value(n) AS n, x, count(*) AS c FROM (SELECT item_id, len(w) AS n,
    unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS x FROM b WHERE len(w) > 4) GROUP BY 1, 3),
s AS (SELECT DISTINCT doc_id, item_id, n, words, unnest(range(greatest(0, least(pos - (least(n, words) - 5), words - n)), least(pos, greatest(words - n, 0)) + 1)) AS s FROM e JOIN i USING (x)),
c AS (SELECT s.doc_id, s.item_id, s.n, s.words, s.s, e.x, count(*) AS cw FROM s JOIN e ON e.doc_id = s.doc_id AND e.pos >= s.s AND e.pos <= s.s + least(s.n, s.words) - 5 GROUP BY ALL),
m AS (SELECT doc_id, item_id, c.n, words, s, sum(least(cw, c)) AS common FROM c JOIN i USING (item_id, x) GROUP BY ALL),
v AS (SELECT *, common / (least(n, words) - 4 + n - 4 - common) AS similarity FROM m WHERE 100 * common >= 80 * (least(n, words) - 4 + n - 4 - common))
SELECT doc_id, item_id, s::INT AS start, least(n, words)::INT AS n_words, round(similarity, 6) AS similarity FROM v
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, s) = 1
"""


def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path, pattern = _tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    found = bpe.encode(_table(spark, folder, "documents").select("doc_id", "text"), path, pattern, decoded=True)
    return found.select(
        "doc_id", F.expr("cast(octet_length(token_ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_difference_cover(spark: SparkSession, folder: str) -> DataFrame:
    found = passages.remove_passages(_table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


_OP8 = rf"""
WITH w AS (SELECT doc_id, row_number() OVER () AS row, coalesce(regexp_extract_all(text, '{WORD}'), []) AS w FROM documents),
g AS (SELECT row, unnest(range(1, len(w) - 33)) AS s, unnest(list_transform(range(1, len(w) - 33), lambda i: array_to_string(w[i:i + 34], ' '))) AS x FROM w WHERE len(w) > 34),
r AS (SELECT row, s FROM g QUALIFY count(*) OVER (PARTITION BY x) > 1),
q AS (SELECT DISTINCT row, unnest(range(s, s + 35)) AS i FROM r),
k AS (SELECT row, i, word FROM (SELECT row, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM w) ANTI JOIN q USING (row, i)),
t AS (SELECT row, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t FROM k GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN t USING (row)
"""


def op9_decision_list(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.judged(_table(spark, folder, "documents"), _table(spark, folder, "labels"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_block_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = html.extract(_table(spark, folder, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def _crc32(text: str) -> str:
    """The unsigned crc32 of a text, bit by bit."""
    return f"""xor(list_reduce(flatten(list_transform(regexp_extract_all(hex({text}), '..'), lambda h: list_transform(range(8), lambda k: (('0x' || h)::BIGINT >> k) & 1))),
    lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)), 4294967295), 4294967295)::BIGINT"""


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.prefix_trie(*trie.with_shared_heads(trie.ordered(_table(spark, folder, "conversations"))))


_OP11 = f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
    coalesce(role, ''), md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS k FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, {_crc32("conv_id::VARCHAR")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, k, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND k < h
    UNION ALL SELECT conv_id, k, role, text FROM t JOIN c USING (conv_id) WHERE k >= h),
s AS (SELECT conv_id, row_number() OVER w AS depth, length(text) AS chars, md5(string_agg(md5(role) || md5(text), '') OVER w) AS node
    FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY k) UNION ALL SELECT conv_id, 0, 0, '' FROM c),
m AS (SELECT *, lag(node) OVER w AS up, lead(node) OVER w IS NULL AS ends FROM s WINDOW w AS (PARTITION BY conv_id ORDER BY depth)),
n AS (SELECT depth, node, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(chars) AS saved, bool_and(ends) AS leaf,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM m GROUP BY 1, 2),
b AS (SELECT DISTINCT a.depth, a.node, d.depth AS below_depth, d.node AS below FROM m a JOIN m d ON a.conv_id = d.conv_id AND d.depth >= a.depth),
x AS (SELECT b.depth, b.node, sum(leaf::INT) AS leaves, sum(saved) AS saved_tokens FROM b JOIN n ON n.depth = below_depth AND n.node = below GROUP BY 1, 2),
k AS (SELECT depth - 1 AS depth, up AS node, count(*) AS children FROM n WHERE depth > 0 GROUP BY 1, 2)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(children, 0)::BIGINT AS n_children, leaves::BIGINT AS n_leaves,
    saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM n JOIN x USING (depth, node) LEFT JOIN k USING (depth, node) LEFT JOIN n p ON p.depth = n.depth - 1 AND p.node = n.up
"""


def op12_token_files(spark: SparkSession, folder: str) -> DataFrame:
    found = tokenfiles.token_table(_table(spark, folder, "documents"), _tokenizer("byte_bpe_50k.json"), end_id=2, named=True)
    return found.select("doc_id", "start", "n_tokens", F.crc32("token_ids").alias("ids_crc32"))


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, folder, "documents"))


_OP13 = rf"""
WITH RECURSIVE
r AS (SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{{C0}}-\x{{FF}}]{{7,}}')) AS run FROM documents),
c AS (SELECT run, count(*) AS n, {_crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM r GROUP BY doc_id, run),
v AS (SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM c)
    WHERE length(word) >= 7 GROUP BY 1 HAVING sum(n) >= 2),
e AS (SELECT word, left(word, i - 1) || '?' || substr(word, i + 1) AS hole, left(word, i - 1) || substr(word, i + 1) AS less
    FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)),
p AS (SELECT a.word AS a, b.word AS b FROM e a JOIN e b ON a.hole = b.hole AND a.word != b.word
    UNION SELECT e.word, v.word FROM e JOIN v ON e.less = v.word UNION SELECT v.word, e.word FROM e JOIN v ON e.less = v.word),
q AS (SELECT a AS word, b, n AS bn, count(*) OVER (PARTITION BY a) AS n_near FROM p JOIN v ON v.word = b
    QUALIFY row_number() OVER (PARTITION BY a ORDER BY n DESC, b) = 1),
f AS (SELECT v.word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN bn >= 10 * n THEN b END AS form, CASE WHEN bn >= 10 * n THEN bn END AS form_n
    FROM v LEFT JOIN q USING (word)),
t AS (SELECT word, word AS at FROM f UNION ALL SELECT t.word, f.form FROM t JOIN f ON f.word = t.at WHERE f.form IS NOT NULL)
SELECT t.word, o.form, t.at AS root, o.n, o.n_near, o.form_n FROM t JOIN f ON f.word = t.at AND f.form IS NULL JOIN f o ON o.word = t.word
"""


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_sampled_splitters": op3_sampled_splitters,
    "op4_host_reputation": op4_host_reputation,
    "op5_count_viterbi": op5_count_viterbi,
    "op6_simhash_decontamination": op6_simhash_decontamination,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_difference_cover": op8_difference_cover,
    "op9_decision_list": op9_decision_list,
    "op10_block_rules": op10_block_rules,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_token_files": op12_token_files,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLES = {
    "op1_line_dedup": _OP1,
    "op2_minhash_near_dedup": _OP2,
    "op3_sampled_splitters": _OP3,
    "op4_host_reputation": _OP4,
    "op6_simhash_decontamination": _OP6,
    "op8_difference_cover": _OP8,
    "op11_prefix_trie": _OP11,
    "op13_spelling_variants": _OP13,
}
