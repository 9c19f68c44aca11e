"""Queries that apply the operators of this subpackage to whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vitrine.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return wrap


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op2_packing")
def op2_packing(spark, sf_dir):
    """Order-preserving packing of all documents into sequences of at most 2048 tokens."""
    from vitrine.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"))


@register("op6_token_counts")
def op6_token_counts(spark, sf_dir):
    """Tokens of every document, by a separator scan of flat token files."""
    from vitrine.llm.token_counts import document_tokens

    return document_tokens(table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"))


@register("op10_byte_bpe")
def op10_byte_bpe(spark, sf_dir):
    """Byte-level BPE ids of every document and the bytes that they decode to."""
    import public_tokenizers

    from vitrine.llm.byte_bpe import encode

    return encode(
        table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
        outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


@register("op7_fingerprints")
def op7_fingerprints(spark, sf_dir):
    """Homomorphic fingerprints of all texts and of their edited texts."""
    from vitrine.llm.fingerprints import edited_documents

    return edited_documents(table(spark, sf_dir, "documents"))


@register("op8_secrets")
def op8_secrets(spark, sf_dir):
    """Secrets of every document, weak ones only next to their complements."""
    from vitrine.llm import secrets

    return secrets.counts(secrets.scan(table(spark, sf_dir, "documents")))


@register(
    "op1_near_vectors",
    """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
link AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE len(a.e) = len(b.e)
    AND list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= 0.93
),
reach(u, w) AS (
  SELECT u, w FROM link UNION SELECT r.u, l.w FROM reach r JOIN link l ON r.w = l.u
),
least AS (SELECT u, min(w) AS m FROM reach GROUP BY u),
num AS (SELECT u, count(*) AS n FROM link GROUP BY u)
SELECT e.vec_id, coalesce(n, 0) AS n_links, least(e.vec_id, coalesce(m, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(m, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN num ON num.u = e.vec_id LEFT JOIN least ON least.u = e.vec_id
""",
)
def op1_near_vectors(spark, sf_dir):
    """Near-copies among all embeddings of a label, by p-stable hashing and exact cosines."""
    from vitrine.llm.near_vectors import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings"))


@register("op5_language")
def op5_language(spark, sf_dir):
    """Language of every document, learned from three quarters of the labelled ones."""
    from pyspark.sql import functions as F

    from vitrine.llm import language

    docs = table(spark, sf_dir, "documents")
    model = language.learn(docs, ~language.held_out())
    return language.identify(docs, model).select(
        "doc_id", language.held_out().alias("held_out"), "lang_pred", F.col("score"), "cross_entropy", "rejected")


@register(
    "op3_warc",
    """
WITH h AS (SELECT page_id, coalesce(html, '') AS p FROM pages),
d AS (
  SELECT page_id, CAST(strlen(p) AS BIGINT) AS payload_bytes, sha1(p) AS x, max(page_id) OVER (PARTITION BY sha1(p)) AS latest FROM h
),
v AS (SELECT *, list_transform(range(8), lambda g: CAST('0x' || substr(x, CAST(5 * g + 1 AS INT), 5) AS BIGINT)) AS five FROM d)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                CAST(1 + (five[CAST(i // 4 + 1 AS INT)] // CAST(pow(32, 3 - i % 4) AS BIGINT)) % 32 AS INT), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = latest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> latest THEN latest END AS refers_to
FROM v
""",
)
def op3_warc(spark, sf_dir):
    """A WARC record for every page, read back from the archives."""
    from vitrine.llm.warc import archive_round_trip

    return archive_round_trip(table(spark, sf_dir, "pages"))


@register(
    "op9_ngram_join",
    r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
         lambda x: x <> '') AS words FROM documents
),
s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i : i + 3], ' '))) END AS shingles
  FROM w
),
sets AS (SELECT min(doc_id) AS rep, list_sort(shingles) AS sh FROM s WHERE len(shingles) > 0 GROUP BY list_sort(shingles)),
tok AS (SELECT rep, unnest(sh) AS t FROM sets),
df AS (SELECT t, count(*) AS f FROM tok GROUP BY t HAVING count(*) > 1),
ranked AS (
  SELECT tok.rep, tok.t, len(sets.sh) AS n, coalesce(f, 1) AS f,
         row_number() OVER (PARTITION BY tok.rep ORDER BY coalesce(f, 1), tok.t) AS k
  FROM tok JOIN sets USING (rep) LEFT JOIN df USING (t)
),
pre AS (SELECT rep, t FROM ranked WHERE k <= n - ((85 * n + 99) // 100) + 1 AND f > 1),
cand AS (SELECT DISTINCT a.rep AS u, b.rep AS v FROM pre a JOIN pre b ON a.t = b.t AND a.rep < b.rep),
link AS (
  SELECT u, v FROM cand JOIN sets a ON a.rep = u JOIN sets b ON b.rep = v
  WHERE 100 * len(list_intersect(a.sh, b.sh)) >= 85 * (len(a.sh) + len(b.sh) - len(list_intersect(a.sh, b.sh)))
),
both_ways AS (SELECT u, v FROM link UNION SELECT v, u FROM link),
reach(u, v) AS (SELECT u, v FROM both_ways UNION SELECT r.u, b.v FROM reach r JOIN both_ways b ON r.v = b.u),
least AS (SELECT u, min(v) AS m FROM reach GROUP BY u)
SELECT s.doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles,
       coalesce(least(rep, coalesce(m, rep)), s.doc_id) AS component_id
FROM s LEFT JOIN sets ON len(shingles) > 0 AND list_sort(s.shingles) = sets.sh LEFT JOIN least ON least.u = rep
""",
)
def op9_ngram_join(spark, sf_dir):
    """Documents whose sets of four-word shingles have a Jaccard similarity of 0.85 or more."""
    from vitrine.llm.ngram_join import ngram_join

    return ngram_join(table(spark, sf_dir, "documents"))


def _license_oracle() -> str:
    from vitrine.llm.licenses import oracle_sql

    return oracle_sql()


@register("op4_licenses", _license_oracle())
def op4_licenses(spark, sf_dir):
    """Licence rules that match the sentences of each document."""
    from vitrine.llm.licenses import scan

    return scan(table(spark, sf_dir, "documents"))


@register(
    "op11_lexical_search",
    r"""
WITH item AS (
  SELECT item_id, row_number() OVER () AS q,
         list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM benchmark
),
wanted AS (SELECT q, term, count(*) AS times FROM (SELECT q, unnest(words) AS term FROM item) GROUP BY q, term),
doc AS (
  SELECT doc_id, row_number() OVER () AS d,
         list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM documents
),
size AS (SELECT doc_id, d, CAST(len(words) AS BIGINT) AS n FROM doc WHERE len(words) > 0),
corpus AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM size),
posting AS (
  SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(words) AS term FROM doc)
  WHERE term IN (SELECT term FROM wanted) GROUP BY d, term
),
weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM posting, corpus GROUP BY term, big_n
),
scored AS (
  SELECT q, doc_id, d, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * big_n) // big_l)))) AS BIGINT) AS score
  FROM wanted JOIN posting USING (term) JOIN weight USING (term) JOIN size USING (d), corpus GROUP BY q, doc_id, d
),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS FIRST) AS place FROM scored WHERE score > 0
)
SELECT item_id, CAST(place AS INT) AS rank, doc_id, score FROM ordered JOIN item USING (q) WHERE place <= 20
""",
)
def op11_lexical_search(spark, sf_dir):
    """The 20 best documents of every benchmark item, by inner products over norm buckets."""
    from vitrine.llm.lexical import ranked_search

    return ranked_search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


@register(
    "op12_merkle",
    r"""
WITH RECURSIVE edit AS (
  SELECT *, CASE WHEN text LIKE '%' || chr(10) || '%' THEN replace(text, chr(10), '') END AS without,
         row_number() OVER () AS r FROM documents
),
leaf AS (
  SELECT r, doc_id, coalesce('=' || source, '') AS tree,
    coalesce(concat(strlen(CAST(doc_id AS VARCHAR)), ':', doc_id), '-') || coalesce(concat(strlen(source), ':', source), '-')
      || coalesce(concat(strlen(lang), ':', lang), '-') || coalesce(concat(strlen(CAST(n_chars AS VARCHAR)), ':', n_chars), '-') AS head,
    text, without
  FROM edit
),
hashed AS (
  SELECT r, doc_id, tree, sha256(head || coalesce(concat(strlen(text), ':', text), '-')) AS node,
         sha256(head || coalesce(concat(strlen(without), ':', without), '-')) AS other, without IS NOT NULL AS cut
  FROM leaf
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, node) - 1 AS pos FROM hashed
),
low(tree, lvl, pos, node, total) AS (
  SELECT tree, 0, pos, node, count(*) OVER (PARTITION BY tree) FROM placed
  UNION ALL
  SELECT tree, any_value(lvl) + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (any_value(total) + 2) // 3
  FROM low WHERE total > 1 GROUP BY tree, pos // 3
),
sub AS (SELECT tree, node, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS total FROM low WHERE total = 1),
high(lvl, pos, node, total) AS (
  SELECT 0, pos, node, total FROM sub
  UNION ALL
  SELECT any_value(lvl) + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (any_value(total) + 2) // 3
  FROM high WHERE total > 1 GROUP BY pos // 3
),
low_run AS (
  SELECT a.tree, a.lvl, a.pos, coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS before,
         coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS after
  FROM low a JOIN low b ON a.tree = b.tree AND a.lvl = b.lvl AND a.pos // 3 = b.pos // 3 AND a.total > 1
  GROUP BY a.tree, a.lvl, a.pos
),
high_run AS (
  SELECT a.lvl, a.pos, coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS before,
         coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS after
  FROM high a JOIN high b ON a.lvl = b.lvl AND a.pos // 3 = b.pos // 3 AND a.total > 1 GROUP BY a.lvl, a.pos
),
power AS (SELECT k, CAST(pow(3, k) AS BIGINT) AS p FROM range(39) AS t(k)),
way AS (
  SELECT l.r, u.lvl AS step, u.before, u.after FROM placed l, power JOIN low_run u ON u.tree = l.tree AND u.lvl = k AND u.pos = l.pos // p
  UNION ALL
  SELECT l.r, 100 + u.lvl, u.before, u.after FROM placed l JOIN sub s ON s.tree = l.tree, power
  JOIN high_run u ON u.lvl = k AND u.pos = s.pos // p
),
path AS (
  SELECT r, list(before ORDER BY step) AS befores, list(after ORDER BY step) AS afters, string_agg(before || after, '' ORDER BY step) AS joined
  FROM way GROUP BY r
),
climb(r, i, node) AS (
  SELECT r, 1, CASE WHEN cut AND list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(
           string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
         lambda c, x: list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0],
           lambda y, z: CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384) ELSE y // 2 END)) % 2 = 1 THEN other ELSE node END
  FROM placed
  UNION ALL
  SELECT r, i + 1, sha256(befores[i] || node || afters[i]) FROM climb JOIN path USING (r) WHERE i <= len(befores)
),
folded AS (SELECT r, arg_max(node, i) AS node FROM climb GROUP BY r)
SELECT doc_id, placed.node AS leaf, sub.node AS subroot, high.node AS root, sha256(coalesce(joined, '')) AS proof_sha256,
       folded.node AS folded_root, folded.node = high.node AS verified
FROM placed JOIN sub USING (tree) JOIN high ON high.total = 1 JOIN folded USING (r) LEFT JOIN path USING (r)
""",
)
def op12_merkle(spark, sf_dir):
    """Merkle manifest of all documents, and which of the edited texts it disproves."""
    from vitrine.llm.merkle import manifest, without_line_ends

    return manifest(table(spark, sf_dir, "documents"), claimed=without_line_ends()).drop("proof")


@register("op13_toxicity")
def op13_toxicity(spark, sf_dir):
    """Toxicity of every document by its nearest labelled examples."""
    from vitrine.llm import toxicity

    docs = table(spark, sf_dir, "documents")
    index = toxicity.learn(docs, table(spark, sf_dir, "labels"), ~toxicity.held_out())
    return toxicity.score(docs, index).withColumn("held_out", toxicity.held_out())
