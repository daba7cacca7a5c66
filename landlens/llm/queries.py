"""Registered queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pin, table
from . import chat_format, embedding_dedup, exact_dedup, license_scan, merkle, mixing, ngram_join, packing, phrases, quality, suffix_dedup, token_files, url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle
        return fn
    return deco


@query("op1_suffix_dedup")
def op1_suffix_dedup(spark, folder):
    cut = suffix_dedup.drop_repeats(table(spark, folder, "documents").select("doc_id", "text"), with_text=False)
    return cut.select("doc_id", "n_bytes", "n_removed", (F.size("spans") / 2).cast("bigint").alias("n_spans"), "kept_sha256")


@query("op2_chat_format", """
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
m AS (SELECT *, replace(text, chr(92), repeat(chr(92), 2)) AS t1, replace(role, chr(92), repeat(chr(92), 2)) AS r1 FROM c),
e AS (SELECT *, length(regexp_replace(t1, '<[|]|</?s>|<</?SYS>>|\\[/?INST\\]|<pad>|<unk>|<[be]os>|<(start|end)_of_turn>', '\\0_', 'g')) AS tl,
      length(regexp_replace(r1, '<[|]|</?s>|<</?SYS>>|\\[/?INST\\]|<pad>|<unk>|<[be]os>|<(start|end)_of_turn>', '\\0_', 'g')) AS rl FROM m)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(rl + tl + 23) AS BIGINT) AS formatted_chars FROM e GROUP BY conv_id""")
def op2_chat_format(spark, folder):
    said = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], said.schema)
    formatted = chat_format.format_conversations(said.unionByName(planted))
    return chat_format.read_back(formatted).drop("n_tokens", "loss_tokens")


@query("op3_license_scan")
def op3_license_scan(spark, folder):
    found = license_scan.scan(table(spark, folder, "documents").select("doc_id", "text"))
    starts = F.transform("base", lambda b: b["start"])
    base_labels = F.array_join(F.array_sort(F.array_distinct(F.transform("base", lambda b: b["label"]))), ",")
    return found.select("doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                        base_labels.alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score", F.size("detections").cast("bigint").alias("n_detections"))


@query("op4_sequence_packing")
def op4_sequence_packing(spark, folder):
    return packing.pack(table(spark, folder, "documents").select("doc_id", "text"))


@query("op5_exact_dedup", r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)""")
def op5_exact_dedup(spark, folder):
    return exact_dedup.exact_groups(table(spark, folder, "documents").select("doc_id", "text"))


@query("op6_ngram_join")
def op6_ngram_join(spark, folder):
    return ngram_join.similar_groups(table(spark, folder, "documents").select("doc_id", "text"))


@query("op7_embedding_dedup")
def op7_embedding_dedup(spark, folder):
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"))


HELD_OUT = "pmod(crc32(cast(doc_id as string)), 5) = 0"
KEEP_FROM = 0.3


@query("op8_quality_classifier")
def op8_quality_classifier(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, folder, "labels"), ~F.expr(HELD_OUT))
    return quality.score(docs, model).select("doc_id", F.expr(HELD_OUT).alias("held_out"), "score", (F.col("score") >= KEEP_FROM).cast("int").alias("predicted"))


#: The rules of the contract, and the names of hosts whose pages make up the block list.
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
SPAM_HOSTS = ["casino-win", "cheap-pills", "free-bets", "spam-farm"]


@query("op9_url_filter", r"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url, strpos(coalesce(url, ''), '://') AS p FROM pages),
r AS (SELECT page_id, CASE WHEN p > 0 THEN substr(url, p + 3) ELSE '' END AS rest FROM u),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
      regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
k AS (SELECT *, regexp_replace(host, '^www[.]', '') || regexp_replace(path, '/+$', '') AS key FROM h),
l AS (SELECT DISTINCT key FROM k WHERE regexp_matches(host, '(^|[.])(casino-win|cheap-pills|free-bets|spam-farm)[.]')),
f AS (SELECT k.page_id, k.host, k.path, l.key IS NOT NULL AS listed,
      CASE WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
           WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
           WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
           WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
           WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
      FROM k LEFT JOIN l ON k.key = l.key)
SELECT page_id, host, path, rule, listed, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN listed THEN 'block' ELSE 'allow' END AS verdict FROM f""")
def op9_url_filter(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url")
    host, path = url_filter.host_and_path(F.col("url"))
    listed = (pages.select(host.alias("host"), path.alias("path")).where(F.regexp_like("host", F.lit(r"(^|[.])(" + "|".join(SPAM_HOSTS) + r")[.]")))
              .select(url_filter.canonical(F.col("host"), F.col("path")).alias("key")))
    return url_filter.judge(pages, listed, URL_RULES)


@query("op10_source_mix")
def op10_source_mix(spark, folder):
    mixed = mixing.mix(table(spark, folder, "documents").select("doc_id", "text", "source"), [5, 2, 1])
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "repeats")


@query("op11_phrase_mining", r"""
WITH s AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM s),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
g AS (SELECT lang, d, unnest(list_transform(range(1, len(ws) - d + 2), lambda i: array_to_string(ws[i:i + d - 1], ' '))) AS phrase FROM w CROSS JOIN range(1, 6) AS t(d)),
c AS (SELECT lang, d, phrase, string_split(phrase, ' ') AS ws, count(*) AS f FROM g GROUP BY lang, d, phrase HAVING count(*) >= 100),
n AS (SELECT lang, sum(len(ws)) AS n FROM w GROUP BY lang),
inside AS (SELECT DISTINCT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, f FROM c CROSS JOIN range(1, 5) AS a(i) CROSS JOIN range(2, 5) AS b(m) WHERE m < d AND i + m - 1 <= d),
x AS (SELECT c.lang, c.d, c.phrase, c.ws, c.f AS a FROM c WHERE d > 1 AND NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = c.lang AND i.phrase = c.phrase AND 100 * i.f >= 100 * c.f)),
k AS (SELECT x.lang, x.phrase, x.a, l.f AS l, r.f AS r, n.n, k, (1000::HUGEINT * x.a * n.n) // (l.f::HUGEINT * r.f) AS score FROM x CROSS JOIN range(1, 5) AS q(k)
    JOIN c l ON l.lang = x.lang AND l.phrase = array_to_string(x.ws[1:k], ' ') JOIN c r ON r.lang = x.lang AND r.phrase = array_to_string(x.ws[k + 1:x.d], ' ') JOIN n ON n.lang = x.lang WHERE k < x.d),
b AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
    CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM b QUALIFY rank <= 2000""")
def op11_phrase_mining(spark, folder):
    return phrases.collocations(table(spark, folder, "documents").select("lang", "text"))


@query("op12_token_files")
def op12_token_files(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_files.read_documents(token_files.write(docs), docs.schema["doc_id"].dataType.simpleString())


TAMPERED = "pmod(crc32(cast(doc_id as string)), 7) = 0"


@query("op13_merkle_manifest", """
WITH RECURSIVE c AS (SELECT *, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: [CAST(ascii(x) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
    lambda x, e: xor(xor(x, e) >> 1, 3988292384 * (xor(x, e) & 1))), 4294967295) % 7 = 0 AS bad FROM documents),
p AS (SELECT doc_id, lang, bad, n_chars, coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
    || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS head, coalesce(octet_length(encode(text)) || ':' || text, '-') AS tail FROM c),
d AS (SELECT doc_id, lang, sha256(head || coalesce(length(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
    sha256(head || coalesce(length(CAST(n_chars + CASE WHEN bad THEN 1 ELSE 0 END AS VARCHAR)) || ':' || (n_chars + CASE WHEN bad THEN 1 ELSE 0 END), '-') || tail) AS claimed FROM p),
l AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM d),
t AS (SELECT lang, 0 AS level, pos, n, leaf AS h FROM l
    UNION ALL SELECT lang, level + 1, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM t WHERE n > 1 GROUP BY lang, level, pos // 2),
s AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT 0 AS level, pos, n, h FROM s UNION ALL SELECT level + 1, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM u WHERE n > 1 GROUP BY level, pos // 2),
f AS (SELECT lang, pos, n, 0 AS level, claimed AS h, '' AS proof FROM l
    UNION ALL SELECT f.lang, f.pos, f.n, f.level + 1, sha256(CASE WHEN (f.pos >> f.level) & 1 = 1 THEN coalesce(t.h, '') || f.h ELSE f.h || coalesce(t.h, '') END), f.proof || coalesce(t.h, '')
    FROM f LEFT JOIN t ON f.lang IS NOT DISTINCT FROM t.lang AND t.level = f.level AND t.pos = xor(f.pos >> f.level, 1) WHERE (1 << f.level) < f.n),
g AS (SELECT f.lang, f.pos, s.pos AS at, s.n, 0 AS level, f.h, f.proof FROM f JOIN s ON f.lang IS NOT DISTINCT FROM s.lang WHERE (1 << f.level) >= f.n
    UNION ALL SELECT g.lang, g.pos, g.at, g.n, g.level + 1, sha256(CASE WHEN (g.at >> g.level) & 1 = 1 THEN coalesce(u.h, '') || g.h ELSE g.h || coalesce(u.h, '') END), g.proof || coalesce(u.h, '')
    FROM g LEFT JOIN u ON u.level = g.level AND u.pos = xor(g.at >> g.level, 1) WHERE (1 << g.level) < g.n)
SELECT l.doc_id, l.leaf, s.h AS subroot, r.h AS root, sha256(g.proof) AS proof_sha256, g.h AS folded_root, g.h = r.h AS verified
FROM l JOIN s ON l.lang IS NOT DISTINCT FROM s.lang JOIN g ON g.lang IS NOT DISTINCT FROM l.lang AND g.pos = l.pos AND (1 << g.level) >= g.n CROSS JOIN (SELECT h FROM u WHERE n = 1) r""")
def op13_merkle_manifest(spark, folder):
    docs = table(spark, folder, "documents")
    leaf = lambda n_chars: merkle.leaf_hash([F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text")])
    rows = pin(docs.select("doc_id", F.col("lang").cast("string").alias("grp"), leaf(F.col("n_chars")).alias("leaf"),
                           F.when(F.expr(TAMPERED), leaf(F.col("n_chars") + 1)).alias("_other"))
               .select("doc_id", "grp", "leaf", F.coalesce("_other", "leaf").alias("claimed")))
    found = merkle.proofs(merkle.manifest(rows), "claimed")
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
