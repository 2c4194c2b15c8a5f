"""The registered queries of the training-data operators: thin, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queuelake.llm import embedding_dedup, exact_dedup, jaccard_join, language_id, lm_scoring, packing, phrase_index, prefix_trie, source_mixing, spelling_variants, substring_dedup, token_counts, toxicity
from queuelake.llm.shared import documents
from queuelake.session import prepare


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    pieces = packing.pack_documents(documents(prepare(spark), sf_dir), keep_ids=False)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document under the model and under word frequencies."""
    return lm_scoring.score_documents(documents(prepare(spark), sf_dir))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with equal text but for white space."""
    return exact_dedup.exact_groups(documents(prepare(spark), sf_dir))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share four fifths of their five-word shingles."""
    return jaccard_join.near_duplicates(documents(prepare(spark), sf_dir))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labelled ones."""
    labels = prepare(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.toxicity(documents(spark, sf_dir), labels)


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passes of all documents in a mixture whose sources repeat at most twice."""
    mixed = source_mixing.mix(documents(prepare(spark), sf_dir).select("doc_id", "source", "text"))
    return mixed.select("doc_id", "source", F.col("mix_copy").cast("bigint").alias("mix_copy"), "mix_block", "mix_place")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return language_id.identify(documents(prepare(spark), sf_dir))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated strings of 200 bytes."""
    return substring_dedup.remove_repeats(documents(prepare(spark), sf_dir))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy word-piece counts of every document."""
    return token_counts.count_tokens(documents(prepare(spark), sf_dir))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of embeddings with a cosine of 0.98 or more inside a label."""
    return embedding_dedup.near_vectors(prepare(spark).read.parquet(f"{sf_dir}/embeddings.parquet"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with the words they are likely variants of."""
    return spelling_variants.spelling_variants(documents(prepare(spark), sf_dir))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations."""
    return prefix_trie.conversation_trie(prepare(spark).read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in ten-word passages of benchmark items."""
    items = prepare(spark).read.parquet(f"{sf_dir}/benchmark.parquet")
    return phrase_index.contamination(documents(spark, sf_dir), items)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pack": op1_pack,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_toxicity": op5_toxicity,
    "op6_mix_sources": op6_mix_sources,
    "op7_language_id": op7_language_id,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_token_counts": op9_token_counts,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_decontaminate": op13_decontaminate,
}

ORACLE: dict[str, str] = {
    "op3_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
            FROM documents
        ), k AS (
            SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY body) AS group_size
            FROM t WINDOW w AS (PARTITION BY body ORDER BY n DESC, doc_id)
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM k
    """,
    "op4_jaccard_join": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(regexp_replace(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g'), '[^ ]+') AS words
            FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, list_aggregate(words[i : i + 4], 'string_agg', ' ') AS shingle
            FROM w, unnest(generate_series(1, greatest(len(words) - 4, 1))) AS g(i) WHERE len(words) > 0
        ), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        together AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b USING (shingle) GROUP BY ALL
        ), link AS (
            SELECT a, b FROM together JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)
        ), reach(doc_id, r) AS (
            SELECT a, b FROM link UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON reach.r = link.a
        )
        SELECT w.doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(min(reach.r), w.doc_id)) AS component_id
        FROM w LEFT JOIN n USING (doc_id) LEFT JOIN reach USING (doc_id) GROUP BY w.doc_id
    """,
    "op6_mix_sources": r"""
        WITH RECURSIVE t AS (
            SELECT doc_id, source, coalesce(source, '') AS src,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) + 1 AS tokens,
                   ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS turn
            FROM documents
        ), s AS (SELECT src, sum(tokens)::BIGINT AS total FROM t GROUP BY src),
        e AS (SELECT min(total)::DOUBLE / sum(total) AS lo, max(total)::DOUBLE / sum(total) AS hi FROM s),
        bisect(i, a, b) AS (
            SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
            UNION ALL
            SELECT i + 1, CASE WHEN fits THEN a ELSE (a + b) / 2 END, CASE WHEN fits THEN (a + b) / 2 ELSE b END
            FROM (SELECT i, a, b, pow(e.lo, (a + b) / 2 - 1) / pow(e.hi, (a + b) / 2 - 1) <= 2.0 AS fits FROM bisect, e WHERE i < 60)
        ), x AS (SELECT CASE WHEN e.hi / e.lo <= 2.0 THEN 0.0 ELSE b END AS a FROM bisect, e WHERE i = 60),
        p AS (
            SELECT src, total, pow(total::DOUBLE, a - 1) / min(pow(total::DOUBLE, a - 1)) OVER () AS passes,
                   ceil(total / 1048576.0)::BIGINT AS blocks
            FROM s, x
        ), q AS (
            SELECT *, floor(passes + 1e-9) AS whole, round((passes - floor(passes + 1e-9)) * total)::BIGINT AS budget FROM p
        ), d AS (SELECT t.*, q.*, turn % blocks AS block FROM t JOIN q USING (src)),
        b AS (SELECT src, block, sum(tokens)::BIGINT AS size FROM d GROUP BY ALL),
        c AS (
            SELECT src, block, sum(size) OVER (PARTITION BY src
                ORDER BY ('0x' || substr(md5('mix:' || src || ':' || block), 1, 15))::BIGINT, block) - size AS before FROM b
        ), r AS (
            SELECT d.*, before, before + sum(tokens) OVER (PARTITION BY d.src, d.block ORDER BY turn, doc_id) - tokens AS reached
            FROM d JOIN c ON c.src = d.src AND c.block = d.block
        )
        SELECT doc_id, source, copy AS mix_copy, block AS mix_block, round((copy + before::DOUBLE / total) / passes, 6) AS mix_place
        FROM (SELECT *, unnest(generate_series(0, (whole - 1 + CASE WHEN reached < budget THEN 1 ELSE 0 END)::BIGINT)) AS copy FROM r)
    """,
    "op11_spelling_variants": r"""
        WITH RECURSIVE steps AS (
            SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b : xor(a >> 1, 3988292384 * (a & 1))) ORDER BY i) AS step
            FROM (SELECT i::BIGINT AS i FROM range(256) AS g(i))
        ), run AS (
            SELECT doc, run, count(*) AS times
            FROM (SELECT coalesce(doc_id::VARCHAR, '') AS doc, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{6,}')),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents) GROUP BY ALL
        ), bytes AS (
            SELECT *, flatten(list_transform(string_split(doc || ':' || run, ''), lambda c : CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [195, ord(c) - 64] END)) AS bs
            FROM run
        ), hashed AS (
            SELECT run, times, xor(list_reduce(list_prepend(4294967295, bs), lambda a, b : xor(a >> 8, step[xor(a & 255, b) + 1])), 4294967295) AS h FROM bytes, steps
        ), word AS (
            SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times FROM hashed
        ), v AS (
            SELECT word, sum(times)::BIGINT AS n FROM word WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5
        ), cut AS (
            SELECT word, substr(word, 1, i - 1) || substr(word, i + 1) AS less, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS mask
            FROM v, unnest(generate_series(1, length(word))) AS g(i)
        ), fewer AS (SELECT DISTINCT cut.word AS a, v.word AS b FROM cut JOIN v ON cut.less = v.word),
        near AS (
            SELECT a, b FROM fewer UNION SELECT b, a FROM fewer
            UNION SELECT x.word, y.word FROM cut x JOIN cut y ON x.mask = y.mask WHERE x.word <> y.word
        ), best AS (
            SELECT a, count(*) AS n_near, first(b ORDER BY v.n DESC, b) AS b, max(v.n) AS n_b FROM near JOIN v ON v.word = b GROUP BY a
        ), form AS (
            SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN n_b >= 5 * n THEN b END AS form, CASE WHEN n_b >= 5 * n THEN n_b END AS form_n
            FROM v LEFT JOIN best ON a = word
        ), chain(word, reached, steps) AS (
            SELECT word, word, 0 FROM form
            UNION ALL SELECT chain.word, form.form, steps + 1 FROM chain JOIN form ON form.word = chain.reached WHERE form.form IS NOT NULL
        )
        SELECT form.word, form, root, n, n_near, form_n
        FROM form JOIN (SELECT word, last(reached ORDER BY steps) AS root FROM chain GROUP BY word) USING (word)
    """,
    "op12_prefix_trie": r"""
        WITH steps AS (
            SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b : xor(a >> 1, 3988292384 * (a & 1))) ORDER BY i) AS step
            FROM (SELECT i::BIGINT AS i FROM range(256) AS g(i))
        ), own AS (
            SELECT conv_id AS c, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
        ), hashed AS (
            SELECT c, turns, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(c::VARCHAR, ''), lambda x : ord(x)::BIGINT)),
                lambda a, b : xor(a >> 8, step[xor(a & 255, b) + 1])), 4294967295) % 9 AS h
            FROM own, steps
        ), rebuilt AS (
            SELECT x.c, list_concat(coalesce(y.turns, [])[1 : h], x.turns[h + 1 :]) AS turns FROM hashed x LEFT JOIN own y ON y.c = x.c - x.c % 5
        ), member AS (
            SELECT c, d, turns[1 : d] AS path, len(turns) = d AS ends FROM rebuilt, unnest(generate_series(0, len(turns))) AS g(d)
        ), node AS (
            SELECT d, path, min(c) AS conv_id, count(*) AS n_convs, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '') AS ids
            FROM member GROUP BY d, path
        ), child AS (
            SELECT d - 1 AS d, path[1 : d - 1] AS path, count(*) AS n_children FROM node WHERE d > 0 GROUP BY ALL
        ), sub AS (
            SELECT g.k AS d, path[1 : g.k] AS path, sum((n_children IS NULL)::BIGINT)::BIGINT AS n_leaves,
                   sum(CASE WHEN d > 0 THEN (n_convs - 1) * strlen(path[d].t) ELSE 0 END)::BIGINT AS saved_tokens
            FROM node LEFT JOIN child USING (d, path), unnest(generate_series(0, d)) AS g(k) GROUP BY ALL
        )
        SELECT node.conv_id, d AS depth, parent.conv_id AS parent_conv_id, node.n_convs, coalesce(n_children, 0) AS n_children,
               n_leaves, saved_tokens, sha256(node.ids) AS ends_sha256
        FROM node JOIN sub USING (d, path) LEFT JOIN child USING (d, path)
        LEFT JOIN (SELECT d AS pd, path AS pp, conv_id FROM node) AS parent ON pd = d - 1 AND pp = path[1 : d - 1]
    """,
    "op13_decontaminate": r"""
        WITH d AS (
            SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
        ), b AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
        ), p AS (
            SELECT DISTINCT item_id::VARCHAR AS item_id, ws[i : i + 9] AS phrase
            FROM b, unnest(generate_series(1, greatest(len(ws) - 9, 1))) AS g(i) WHERE len(ws) > 0
        ), h AS (
            SELECT rid, i, n, phrase
            FROM (SELECT rid, i, n, ws[i : i + n - 1] AS phrase FROM d, (SELECT DISTINCT len(phrase) AS n FROM p), unnest(generate_series(1, len(ws) - n + 1)) AS g(i))
            WHERE phrase IN (SELECT phrase FROM p)
        ), c AS (
            SELECT rid, count(DISTINCT j) AS n_hit FROM h, unnest(generate_series(i, i + n - 1)) AS g(j) GROUP BY rid
        ), o AS (
            SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
            FROM (SELECT DISTINCT rid, item_id FROM h JOIN p USING (phrase)) GROUP BY rid
        )
        SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM d LEFT JOIN c USING (rid) LEFT JOIN o USING (rid)
    """,
}
