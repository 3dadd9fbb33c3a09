"""Registered queries of the operators: name -> fn(spark, sf_dir), and their SQL."""

from __future__ import annotations

from cohortlens.llm import align, bpe, byte_bpe, chat, exact_dedup, host_rules, html_text, kmeans_codes, near_dup, packing, toxicity, training_order, warc_revisits
from cohortlens.llm.common import load

QUERIES = {}
SQL = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return deco


@query("op3_bpe_word_table")
def op3(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    return bpe.encode_decode(docs, block=bpe.file_block())


OP2_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g USING (t)
"""


@query("op2_extendible_hash_dedup", OP2_SQL)
def op2(spark, sf_dir):
    return exact_dedup.exact_dedup(load(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op8_best_fit_packing")
def op8(spark, sf_dir):
    return packing.pack(load(spark, sf_dir, "documents"))


@query("op9_fast_similarity_sketch")
def op9(spark, sf_dir):
    return near_dup.near_duplicates(load(spark, sf_dir, "documents"), percent=85)


OP10_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, host, t, regexp_extract_all(t, '[^ \t\n\x0B\f\r]+') AS ws FROM d),
u AS (SELECT doc_id, unnest(ws) AS w1, unnest(range(1, len(ws) + 1)) AS i FROM w),
win AS (SELECT doc_id, i, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3
        FROM u WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
rep AS (SELECT doc_id, i, w3 IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, w1, w2, w3) > 1 AS r FROM win),
cov AS (SELECT doc_id, count(*) FILTER (WHERE c) AS n_repeat_words FROM (
          SELECT doc_id, r OR coalesce(lag(r, 1) OVER o, false) OR coalesce(lag(r, 2) OVER o, false) AS c
          FROM rep WINDOW o AS (PARTITION BY doc_id ORDER BY i)) GROUP BY doc_id),
m AS (SELECT w.doc_id, host, len(ws) AS n_words,
        CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')))
          - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')))) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM w LEFT JOIN cov ON w.doc_id = cov.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
h AS (SELECT host, count(*) AS n, count(*) FILTER (WHERE base_failed OR 10 * n_symbols > word_chars) AS x FROM b GROUP BY host),
p AS (SELECT sum(x) / sum(n) AS m, sum(n) AS nn, count(*) AS hh, sum(x * x / n) AS s2 FROM h),
v AS (SELECT m, nn, (s2 - nn * m * m) / nn - m * (1 - m) * hh / nn AS v FROM p),
k AS (SELECT m, CASE WHEN v > 0 THEN greatest(1.0, m * (1 - m) / v - 1) ELSE nn END AS k FROM v),
bad AS (SELECT host FROM h, k WHERE (x + m * k) / (n + k) > 0.8)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND host NOT IN (SELECT host FROM bad) AS kept,
  host IN (SELECT host FROM bad) AS host_rejected
FROM b
"""


@query("op10_host_rules", OP10_SQL)
def op10(spark, sf_dir):
    return host_rules.apply_host_rules(load(spark, sf_dir, "documents"))


@query("op5_conv_toxicity")
def op5(spark, sf_dir):
    return toxicity.classify(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@query("op4_composite_text_density")
def op4(spark, sf_dir):
    return html_text.main_text(load(spark, sf_dir, "pages"))


CONTROL_CASE = "SELECT -1L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"

OP7_SQL = """
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, replace(replace(replace(replace(replace(replace(replace(text, '\\', '\\\\'), '<<SYS>>', '<\\<SYS>>'),
        '<</SYS>>', '<\\</SYS>>'), '</s>', '<\\/s>'), '<s>', '<\\s>'), '[INST]', '[\\INST]'), '[/INST]', '[\\/INST]') AS esc FROM r),
f AS (SELECT *, length(esc) + CASE WHEN role = 'assistant' THEN 4 ELSE 7 + length(role) + 1 + 8 END AS n FROM e)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(n) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
""".replace("\\\\", "\\")


@query("op7_schema_fingerprint_chat", OP7_SQL)
def op7(spark, sf_dir):
    rows = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.format_conversations(rows.unionByName(spark.sql(CONTROL_CASE))).drop("layout")


ORDER_KEY = 20_250_101


@query("op6_feistel_training_order")
def op6(spark, sf_dir):
    folder, _ = training_order.write_training_order(load(spark, sf_dir, "documents"), ORDER_KEY)
    return training_order.read_training_order(spark, folder)


OP1_SQL = r"""
WITH u AS (SELECT page_id AS p, sha256(coalesce(html, '')) AS sha, 1600000000 + (page_id * 7919) % 10000000 AS t,
             regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS u FROM pages),
s AS (SELECT *, '"' || substr(sha, 1, 16) || '"' AS tag, 'day ' || (t // 86400) AS d,
        regexp_replace(regexp_replace(lower(regexp_extract(u, '^([^/?]*)', 1)), '^www[.]', ''), ':(80|443)$', '') AS host,
        regexp_replace(u, '^[^/?]*', '') AS rest FROM u),
q AS (SELECT *, regexp_replace(regexp_replace(rest, '[?].*$', ''), '/+$', '') AS path,
        regexp_replace(regexp_replace(regexp_extract(rest, '[?](.*)$', 1),
          '(^|&)(utm_[a-z]+|ref|fbclid|gclid|sessionid)=[^&]*', '', 'g'), '^&+', '') AS query FROM s),
c AS (SELECT *, host || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS canonical_url FROM q),
v AS (SELECT p * 2 + 1 AS record_id, canonical_url, t + 3600 * (1 + p % 50) AS ts,
        CASE WHEN p % 10 = 0 THEN '"stale"' WHEN p % 10 IN (1, 3) THEN NULL WHEN p % 10 = 2 THEN 'W/' || tag ELSE tag END AS etag,
        CASE WHEN p % 10 = 3 THEN NULL ELSE d END AS lm FROM c),
f AS (SELECT canonical_url, t, max(p) AS p, arg_max(tag, p) AS tag, arg_max(d, p) AS d, arg_max(sha, p) AS sha FROM c GROUP BY 1, 2),
j AS (SELECT v.*, f.p, f.t, f.tag, f.d, f.sha FROM v ASOF LEFT JOIN f ON v.canonical_url = f.canonical_url AND v.ts > f.t),
st AS (SELECT *, CASE WHEN p IS NULL THEN 'no_earlier_response' WHEN etag IS NULL AND lm IS NULL THEN 'no_validator'
         WHEN CASE WHEN etag IS NOT NULL THEN regexp_replace(etag, '^W/', '') = tag ELSE lm = d END THEN 'resolved'
         ELSE 'validator_mismatch' END AS status FROM j)
SELECT record_id, canonical_url, ts, status, CASE WHEN status = 'resolved' THEN p * 2 END AS refers_to,
  CASE WHEN status = 'resolved' THEN sha256('cache-control: max-age=60' || chr(10) || 'content-type: text/html' || chr(10) || 'date: ' || ts
    || chr(10) || 'etag: ' || tag || chr(10) || 'last-modified: ' || d || chr(10) || 'server: origin') END AS headers_sha256,
  CASE WHEN status = 'resolved' THEN sha END AS payload_sha256
FROM st
"""


@query("op1_revisit_resolution", OP1_SQL)
def op1(spark, sf_dir):
    return warc_revisits.revisit_table(load(spark, sf_dir, "pages"))


@query("op11_pointer_jumping_alignment")
def op11(spark, sf_dir):
    return align.align_corpus(load(spark, sf_dir, "documents"))


@query("op12_monoid_byte_bpe")
def op12(spark, sf_dir):
    return byte_bpe.encode_decode(load(spark, sf_dir, "documents"))


def _op13_round(k: int) -> str:
    """Assignment under codebook k, and codebook k + 1."""
    apart = " + ".join(f"(a.x{d} - c.x{d}) * (a.x{d} - c.x{d})" for d in range(4))
    mean = ", ".join(f"coalesce(CAST(floor(m.s{d} / m.n) AS BIGINT), c.x{d}) AS x{d}" for d in range(4))
    return f"""
a{k} AS (SELECT a.r, a.p, min(({apart}) * 64 + c.e) AS m FROM part a JOIN c{k} c ON a.p = c.p GROUP BY a.r, a.p),
m{k} AS (SELECT p, e, count(*) AS n, {", ".join(f"sum(x{d}) AS s{d}" for d in range(4))}
         FROM (SELECT a.p, a.m % 64 AS e, x0, x1, x2, x3 FROM a{k} a JOIN part USING (r, p)) GROUP BY p, e),
c{k + 1} AS (SELECT c.p, c.e, {mean} FROM c{k} c LEFT JOIN m{k} m ON c.p = m.p AND c.e = m.e),"""


OP13_SQL = f"""
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec
           FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
n AS (SELECT *, row_number() OVER (ORDER BY vec_id, vec) AS r FROM v),
part AS (SELECT r, p, {", ".join(f"vec[4 * p + {d + 1}] AS x{d}" for d in range(4))} FROM (SELECT r, vec, unnest(range(16)) AS p FROM n)),
c0 AS (SELECT p, r - 1 AS e, x0, x1, x2, x3 FROM part WHERE r <= 64),{_op13_round(0)}{_op13_round(1)}{_op13_round(2).split("m2 AS")[0]}
code AS (SELECT r, string_agg(printf('%02x', m % 64), '' ORDER BY p) AS code, CAST(sum(m // 64) AS BIGINT) AS error FROM a2 GROUP BY r),
book AS (SELECT sha256(string_agg(concat(x0, ',', x1, ',', x2, ',', x3), ',' ORDER BY p, e)) AS s FROM c2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT s FROM book) AS codebooks_sha256
FROM n JOIN code USING (r)
"""


@query("op13_member_resident_lloyd", OP13_SQL)
def op13(spark, sf_dir):
    return kmeans_codes.compress(load(spark, sf_dir, "embeddings"))
