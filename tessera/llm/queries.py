"""Registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from tessera.llm import (bitslice_topk, chain_dedup, chat_prefix, collocation, importance, langid, separator_scan, simhash_trie,
                         soft_mix, template_decontam, token_files, turn_trie, warc)
from tessera.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document (3 words, 3 bits)."""
    out = simhash_trie.simhash_components(_table(spark, sf_dir, "documents"), size=3, max_bits=3)
    return out.select("doc_id", simhash_trie.hex_fingerprint("fp").alias("fingerprint"), "component_id")


def op1_chat_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every answered conversation against itself with the last answer of the next answered one."""
    chosen, rejected = chat_prefix.swapped_answers(_table(spark, sf_dir, "conversations"))
    return chat_prefix.preference_pairs(chosen, rejected).select(
        F.col("pair_id").alias("conv_id"), "prompt_turns", "prompt", "chosen", "rejected",
        chat_prefix.mask_text("chosen_mask").alias("chosen_mask"), chat_prefix.mask_text("rejected_mask").alias("rejected_mask"))


def op2_template_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents leak, other slot values included."""
    return template_decontam.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def label_domains(labels: DataFrame) -> DataFrame:
    """Domains of the labelled documents: toxic, good or plain."""
    return labels.select("doc_id", F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good")
                         .when(F.col("quality") == 0, "plain").alias("domain"))


#: Token weights of the mixture by domain.
MIXTURE = {"good": 0.90, "plain": 0.08, "toxic": 0.02}


def op3_soft_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate and copies of every document for the mixture's token weights."""
    out = soft_mix.mix(_table(spark, sf_dir, "documents"), label_domains(_table(spark, sf_dir, "labels")), MIXTURE)
    return out.select("doc_id", "tokens", "rate", "copies")


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    languages, probability = langid.fit(docs.where(~langid.held_out()))
    texts = docs.select("doc_id", "text", langid.held_out().alias("held_out"))
    return langid.predict(texts, languages, probability).drop("text")


def op5_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, by scanning flat token files for separators."""
    return separator_scan.document_tokens(_table(spark, sf_dir, "documents"), scratch_path(spark, "tokens"), block_bytes=4 << 20)


def op6_bitslice_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best rows by integer inner product for every 50th vector."""
    vectors = _table(spark, sf_dir, "embeddings")
    return bitslice_topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op8_chain_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of 50 words or more that repeats an earlier one, with its source."""
    return chain_dedup.repeated_passages(_table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page as a WARC record, read the archives back by byte ranges."""
    files = warc.write_archives(_table(spark, sf_dir, "pages"), scratch_path(spark, "warc"), least_bytes=0)
    return warc.read_archives(files, split_bytes=8 << 20, with_payload=False).select(
        warc.page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        warc.page_of("refers_to").alias("refers_to"))


def op10_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance weight of every document, by its words and pairs of words, and whether it is drawn.

    The target is good text that is not toxic; as large a share of the
    documents is drawn as the target has of the labelled rows.
    """
    labels = _table(spark, sf_dir, "labels")
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0")
    share = good.count() / max(1, labels.where("quality is not null").count())
    return importance.resample(_table(spark, sf_dir, "documents"), good, share, order=2)


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every document into token files with offsets, read the files back."""
    parts = token_files.write_token_files(_table(spark, sf_dir, "documents"), scratch_path(spark, "token-set"),
                                          public_tokenizers.path("word_bpe_49k.json"), end=1, by_words=True, plain_words=True)
    return token_files.read_documents(parts).select("doc_id", "start", "n_tokens", "ids_crc32")


def op12_collocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2,000 strongest phrases of 2 to 5 words with 100 occurrences at least."""
    return collocation.collocations(_table(spark, sf_dir, "documents"), least=100, longest=5, top=2000)


def op13_turn_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the conversations rebuilt on their groups' first turns."""
    return turn_trie.crossed_trie(_table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_chat_prefix": op1_chat_prefix,
    "op2_template_decontam": op2_template_decontam,
    "op3_soft_mix": op3_soft_mix,
    "op4_langid": op4_langid,
    "op5_separator_scan": op5_separator_scan,
    "op6_bitslice_topk": op6_bitslice_topk,
    "op7_simhash": op7_simhash,
    "op8_chain_dedup": op8_chain_dedup,
    "op9_warc": op9_warc,
    "op10_importance": op10_importance,
    "op11_token_files": op11_token_files,
    "op12_collocation": op12_collocation,
    "op13_turn_trie": op13_turn_trie,
}

SQL: dict[str, str] = {
    "op1_chat_prefix": """
        WITH t AS (SELECT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
        a AS (
            SELECT conv_id, max(turn) AS turn, arg_max(text, turn) AS text FROM t
            WHERE role = 'assistant' AND text IS NOT NULL GROUP BY conv_id),
        b AS (
            SELECT *, coalesce(lead(text) OVER (ORDER BY conv_id), first_value(text) OVER (ORDER BY conv_id)) AS swap FROM a),
        n AS (SELECT conv_id, turn, swap FROM b WHERE swap <> text),
        x AS (
            SELECT t.conv_id, t.turn, t.role, t.text AS c,
                   CASE WHEN t.turn = n.turn AND t.role = 'assistant' THEN n.swap ELSE t.text END AS r
            FROM t JOIN n USING (conv_id)),
        y AS (SELECT *, min(CASE WHEN c <> r THEN turn END) OVER (PARTITION BY conv_id) AS cut FROM x),
        z AS (
            SELECT conv_id, turn, role, cut IS NULL OR turn < cut AS shared,
                   '<|im_start|>' || role || chr(10) AS h, c || '<|im_end|>' || chr(10) AS cb, r || '<|im_end|>' || chr(10) AS rb
            FROM y),
        w AS (
            SELECT *,
                   coalesce(sum(CASE WHEN NOT shared THEN length(h) + length(cb) END) OVER o, 0) - length(cb) AS c0,
                   coalesce(sum(CASE WHEN NOT shared THEN length(h) + length(rb) END) OVER o, 0) - length(rb) AS r0
            FROM z WINDOW o AS (PARTITION BY conv_id ORDER BY turn))
        SELECT conv_id, count(*) FILTER (shared)::INTEGER AS prompt_turns,
               coalesce(string_agg(h || cb, '' ORDER BY turn) FILTER (shared), '') AS prompt,
               coalesce(string_agg(h || cb, '' ORDER BY turn) FILTER (NOT shared), '') AS chosen,
               coalesce(string_agg(h || rb, '' ORDER BY turn) FILTER (NOT shared), '') AS rejected,
               coalesce(string_agg(c0::BIGINT || '-' || (c0 + length(cb))::BIGINT, ',' ORDER BY turn)
                        FILTER (NOT shared AND role = 'assistant'), '') AS chosen_mask,
               coalesce(string_agg(r0::BIGINT || '-' || (r0 + length(rb))::BIGINT, ',' ORDER BY turn)
                        FILTER (NOT shared AND role = 'assistant'), '') AS rejected_mask
        FROM w GROUP BY conv_id""",
    "op6_bitslice_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), TRUE)),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
            FROM (SELECT DISTINCT * FROM v WHERE vec_id % 50 = 0) q
            JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e)),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5""",
    "op9_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        g AS (SELECT html, max(page_id) AS kept FROM p GROUP BY html),
        r AS (
            SELECT page_id, strlen(p.html)::BIGINT AS payload_bytes, sha1(p.html) AS h,
                   CASE WHEN page_id < kept THEN kept END AS refers_to
            FROM p JOIN g ON p.html = g.html)
        SELECT page_id, payload_bytes,
               list_aggregate(list_transform(range(8), lambda i: list_aggregate(list_transform(range(4), lambda j:
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                          (((('0x' || substr(h, 1 + 5 * i, 5))::BIGINT >> (15 - 5 * j)) & 31) + 1)::BIGINT, 1)),
                   'string_agg', '')), 'string_agg', '') AS payload_digest,
               CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
        FROM r""",
    "op12_collocation": r"""
        WITH d AS (
            SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS id, string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\f\r]') AS pieces
            FROM documents),
        p AS (SELECT lang, list_filter(string_split_regex(unnest(pieces), '[ \t]+'), lambda w: w <> '') AS w FROM d),
        t AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
        o AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p),
        x AS (SELECT lang, w, i, unnest(range(1, least(5, len(w) - i + 1) + 1)) AS m FROM o),
        f AS (SELECT lang, w[i:i + m - 1] AS w, count(*) AS f FROM x GROUP BY 1, 2 HAVING count(*) >= 100),
        c AS (
            SELECT a.lang, a.w, a.f AS a, l.f AS l, r.f AS r, t.n, k, (1000::HUGEINT * a.f * t.n) // (l.f::HUGEINT * r.f) AS score
            FROM (SELECT *, unnest(range(1, len(w))) AS k FROM f WHERE len(w) > 1) a JOIN t ON t.lang = a.lang
            JOIN f l ON l.lang = a.lang AND l.w = a.w[1:k] JOIN f r ON r.lang = a.lang AND r.w = a.w[k + 1:]),
        s AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, k) = 1),
        e AS (
            SELECT DISTINCT b.lang, b.w[i:j] AS part, b.f
            FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM f) b, range(2, 6) y(j)
            WHERE j > i AND j <= len(b.w) AND j - i + 1 < len(b.w)),
        g AS (
            SELECT s.* FROM s WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.lang = s.lang AND e.part = s.w AND 100 * e.f >= 100 * s.a)),
        h AS (
            SELECT lang, array_to_string(w, ' ') AS phrase, a, l, r, n, score::BIGINT AS score FROM g)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM h QUALIFY rank <= 2000""",
    "op13_turn_trie": r"""
        WITH o AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
                PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
            FROM conversations WHERE conv_id IS NOT NULL),
        own AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY pos) AS turns FROM o GROUP BY conv_id),
        h AS (
            SELECT *, conv_id - conv_id % 20 AS base, xor(list_reduce(
                list_concat([4294967295], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 4 AS h
            FROM own),
        c AS (
            SELECT h.conv_id, list_concat(coalesce(b.turns, [])[1:h.h], h.turns[h.h + 1:]) AS turns
            FROM h LEFT JOIN own b ON b.conv_id = h.base),
        m AS (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM c),
        n AS (
            SELECT depth, turns[1:depth] AS path, min(conv_id) AS conv_id, count(*) AS n_convs,
                   coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(turns) = depth), '') AS ends
            FROM m GROUP BY 1, 2),
        k AS (SELECT path[1:depth - 1] AS top, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
        v AS (
            SELECT n.*, coalesce(n_children, 0) AS n_children,
                   CASE WHEN depth > 0 THEN (n_convs - 1) * len(regexp_extract_all(path[depth].text, '[^ \t\n\x0B\f\r]+')) ELSE 0 END AS saved
            FROM n LEFT JOIN k ON k.top = n.path),
        u AS (SELECT *, unnest(range(0, depth + 1)) AS d FROM v),
        s AS (
            SELECT path[1:d] AS path, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM u GROUP BY 1)
        SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, s.n_leaves, s.saved_tokens, sha256(v.ends) AS ends_sha256
        FROM v JOIN s ON s.path = v.path LEFT JOIN v p ON v.depth > 0 AND p.path = v.path[1:v.depth - 1]""",
}
