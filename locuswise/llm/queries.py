"""Queries of the operators in this folder, with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from importlib import import_module

import public_tokenizers
from pyspark.sql import DataFrame

from locuswise.llm.common import table
from locuswise.plans.registry import Query

REGISTRY: dict[str, Query] = {}

BYTE_BPE = "byte_bpe_50k.json"


def query(name: str, sql: str | None = None):
    def wrap(fn):
        REGISTRY[name] = Query(fn, sql)
        return fn

    return wrap


def load_all() -> dict[str, Query]:
    if "pipeline" not in REGISTRY:
        pipeline = import_module("corpus_pipeline")
        REGISTRY["pipeline"] = Query(pipeline.run, pipeline.ORACLE_SQL)
    return dict(REGISTRY)


@query("op1_token_counts")
def _(spark, sf_dir) -> DataFrame:
    from locuswise.llm.tokens import token_counts

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


@query(
    "op3_exact_dedup",
    r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS n FROM documents)
    SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY n) AS group_size, row_number() OVER w = 1 AS kept, sha256(n) AS text_sha256
    FROM d WINDOW w AS (PARTITION BY n ORDER BY length(t) DESC, doc_id)""",
)
def _(spark, sf_dir) -> DataFrame:
    from locuswise.llm.exact_dedup import exact_copies

    return exact_copies(table(spark, sf_dir, "documents"))


@query(
    "op10_url_filters",
    r"""WITH p AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
    q AS (SELECT page_id, regexp_extract(r, '^[^?#]*') AS b FROM p),
    h AS (SELECT page_id, translate(split_part(b, '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, substr(b, length(split_part(b, '/', 1)) + 1) AS path FROM q),
    u AS (SELECT *, regexp_replace(host, '^(www|m)\.', '') || regexp_replace(regexp_replace(path, '(index)?\.html?$', ''), '/+$', '') AS canonical,
      CASE WHEN starts_with(path, '/en/') AND ('.' || host) LIKE '%.www.example.com' THEN 'www.example.com/en/'
        WHEN starts_with(path, '/en/') AND ('.' || host) LIKE '%.example.com' THEN 'example.com/en/'
        WHEN starts_with(path, '/es/') AND ('.' || host) LIKE '%.net' THEN 'net/es/'
        WHEN starts_with(path, '/fr/') AND ('.' || host) LIKE '%.net' THEN 'net/fr/'
        WHEN starts_with(path, '/') AND ('.' || host) LIKE '%.com' THEN 'com/' END AS rule FROM h),
    l AS (SELECT DISTINCT canonical FROM u WHERE canonical <> '' AND regexp_matches(host, 'casino|poker|betting|pills'))
    SELECT page_id, host, path, rule, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
      WHEN canonical IN (SELECT canonical FROM l) THEN 'block' ELSE 'allow' END AS verdict FROM u""",
)
def _(spark, sf_dir) -> DataFrame:
    from locuswise.llm.urls import listed_urls, url_verdicts

    pages = table(spark, sf_dir, "pages")
    return url_verdicts(pages, listed_urls(pages)).select("page_id", "host", "path", "rule", "verdict")


@query("op2_language_id")
def _(spark, sf_dir) -> DataFrame:
    from locuswise.llm.langid import languages

    return languages(table(spark, sf_dir, "documents"))


@query("op4_best_fit_packing")
def _(spark, sf_dir) -> DataFrame:
    from locuswise.llm.packing import packed_documents

    return packed_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


@query("op7_quality_rules")
def _(spark, sf_dir) -> DataFrame:
    from locuswise.llm.rules import fit, quality_verdicts

    docs = table(spark, sf_dir, "documents")
    out = quality_verdicts(docs, fit(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


#: pseudonyms of the query; a real run passes its own secret
PII_KEY = "locuswise-example-key"


@query("op6_pii")
def _(spark, sf_dir) -> DataFrame:
    from locuswise.llm.pii import pseudonymised

    return pseudonymised(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY, count="n_values")


@query("op5_hmm_score")
def _(spark, sf_dir) -> DataFrame:
    from locuswise.llm.hmm import scores

    return scores(table(spark, sf_dir, "documents"))


@query("op9_ngram_jaccard")
def _(spark, sf_dir) -> DataFrame:
    from locuswise.llm.shingle_join import shingle_components

    return shingle_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op8_sentencepiece")
def _(spark, sf_dir) -> DataFrame:
    from locuswise.llm.pieces import decode, digest, encode

    model = public_tokenizers.path("piece_bpe_32k.model")
    return digest(decode(encode(table(spark, sf_dir, "documents"), model), model), model)


@query("op11_best_fit_decreasing")
def _(spark, sf_dir) -> DataFrame:
    from locuswise.llm.windows import windows

    return windows(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


@query(
    "op12_spelling_variants",
    r"""WITH RECURSIVE crcs AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c FROM range(256) r(i))),
    runs AS (SELECT coalesce(doc_id::VARCHAR, '') || ':' AS head, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
    per AS (SELECT head, run, count(*) AS n, hex(encode(head || run)) AS h FROM runs WHERE length(run) >= 5 GROUP BY head, run),
    crc AS (SELECT run, n, xor(list_reduce(list_transform(range(1, length(h), 2), lambda k: ('0x' || substr(h, k, 2))::BIGINT), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS h FROM per, crcs),
    done AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM crc),
    v AS (SELECT word, sum(n)::BIGINT AS n FROM done WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
    cuts AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS c FROM (SELECT word, n, unnest(range(length(word))) AS i FROM v)),
    near AS (SELECT a.word, b.word AS near, b.n FROM cuts a JOIN cuts b ON a.c = b.c AND a.i = b.i AND a.word <> b.word
      UNION SELECT a.word, b.word, b.n FROM cuts a JOIN v b ON a.c = b.word UNION SELECT b.word, a.word, a.n FROM cuts a JOIN v b ON a.c = b.word),
    best AS (SELECT word, count(*) AS n_near, first(near ORDER BY n DESC, near) AS near, max(n) AS near_n FROM near GROUP BY word),
    f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * v.n THEN near END AS form, CASE WHEN near_n >= 2 * v.n THEN near_n END AS form_n FROM v LEFT JOIN best USING (word)),
    up(word, root, form) AS (SELECT word, word, form FROM f UNION ALL SELECT up.word, f.word, f.form FROM up JOIN f ON up.form = f.word)
    SELECT f.word, f.form, up.root, f.n, f.n_near, f.form_n FROM f JOIN up ON f.word = up.word AND up.form IS NULL""",
)
def _(spark, sf_dir) -> DataFrame:
    from locuswise.llm.spelling import spelling_variants

    return spelling_variants(table(spark, sf_dir, "documents"))


@query(
    "op13_source_divergence",
    r"""WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
    o AS (SELECT r, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
    kept AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
    g AS (SELECT DISTINCT lang, source FROM d),
    v AS (SELECT lang, count(term) AS v FROM (SELECT DISTINCT lang FROM d) LEFT JOIN kept USING (lang) GROUP BY lang),
    c AS (SELECT lang, source, term, count(*) AS n FROM o JOIN kept USING (lang, term) GROUP BY ALL),
    t AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT + 2 * any_value(v) AS total FROM g JOIN v USING (lang) LEFT JOIN c USING (lang, source) GROUP BY lang, source),
    p AS (SELECT t.lang, t.source, k.term, coalesce(n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(n, 0) + 2)) // total AS p FROM t JOIN kept k USING (lang) LEFT JOIN c USING (lang, source, term)),
    lt AS (SELECT lang, coalesce(sum(n), 0)::HUGEINT + 2 * any_value(v) AS total FROM v LEFT JOIN c USING (lang) GROUP BY lang),
    q AS (SELECT k.lang, k.term, 1 + (1000000000::HUGEINT * (coalesce(sum(n), 0)::HUGEINT + 2)) // any_value(total) AS q FROM kept k JOIN lt USING (lang) LEFT JOIN c USING (lang, term) GROUP BY k.lang, k.term),
    f AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
    terms AS (SELECT p.lang, p.source, p.term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
    SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM pairs
    UNION ALL SELECT * FROM (SELECT lang, source, 'term' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM terms) WHERE rank <= 10""",
)
def _(spark, sf_dir) -> DataFrame:
    from locuswise.llm.divergence import source_divergence

    return source_divergence(table(spark, sf_dir, "documents"))
