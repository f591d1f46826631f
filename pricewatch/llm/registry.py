"""The queries of the training-data operators and their SQL where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewatch.llm import attention_lm, decontaminate, exact_dedup, hard_negatives, lexical, lines, packing, quality, simhash, substrings, toxicity, urls, warc_zip
from pricewatch.llm.common import fold, table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row of the largest id of each group of equal texts."""
    out = exact_dedup.decide(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op2_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC records into ZIP packages and read back by range."""
    manifest = warc_zip.write_packages(table(spark, sf_dir, "pages"), warc_zip.package_folder(spark))
    return warc_zip.read_packages(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of several permitted lengths."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that lie in windows of benchmark items."""
    found = decontaminate.annotate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select(
        "doc_id",
        F.col("found.n_words").alias("n_words"),
        decontaminate.n_hit().alias("n_hit"),
        F.size("found.item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("found.item_ids"), ","), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of each document."""
    out = simhash.decide(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every unit of text that an earlier document, or the same one before, has."""
    out = lines.repeats(table(spark, sf_dir, "documents"))
    return out.withColumn("digest", F.lower(F.hex("digest")))


def op5_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of each document under the attention model, and its unigram base."""
    return attention_lm.score(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of each document."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(toxicity.labelled_sample(docs, table(spark, sf_dir, "labels")))
    out = toxicity.score(docs, model, into="score", keep=["doc_id"])
    held_out = fold(F.col("doc_id"), toxicity.FOLDS) == toxicity.HELD_OUT
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= toxicity.ACCEPT).cast("int").alias("predicted"))


def op9_quality_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of each document from its text and its site."""
    out = quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))
    held_out = fold(F.col("doc_id"), quality.FOLDS) == quality.HELD_OUT
    return out.withColumn("held_out", held_out).withColumn("keep", F.col("score") >= quality.KEEP)


def op10_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of each page's URL by rule or by path template."""
    out = urls.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))
    return out.select("page_id", "host", "path", "rule", "verdict", "template", "purity")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of each benchmark item."""
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without the strings of 400 bytes that stand elsewhere too."""
    out = substrings.deduplicate(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s.length)
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.lower(F.hex("kept_digest")).alias("kept_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector, under labels of which a seventh are moved on."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 50 == 0)


QUERIES = {f.__name__: f for f in (op1_exact_dedup, op2_warc_zip, op3_best_fit_packing, op4_decontamination, op5_attention_lm, op6_toxicity, op7_simhash, op8_line_dedup, op9_quality_bayes, op10_url_templates, op11_lexical_search, op12_suffix_dedup, op13_hard_negatives)}

QUERIES["pipeline"] = corpus_pipeline.run

SQL: dict[str, str] = {
    "op1_exact_dedup": """
        WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
                   FROM documents),
             g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)""",
    "op2_warc_zip": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
             g AS (SELECT html, max(page_id) AS keep_id FROM p WHERE strlen(html) >= 1000 GROUP BY html)
        SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest,
               CASE WHEN keep_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN keep_id <> page_id THEN keep_id END AS refers_to,
               CASE WHEN keep_id <> page_id THEN NULL ELSE true END AS intact
        FROM p LEFT JOIN g USING (html)""",
    "op4_decontamination": """
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
             i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
             sized AS (SELECT item_id, w, least(13, len(w)) AS k FROM i WHERE len(w) > 0),
             windows AS (SELECT DISTINCT item_id, k, array_to_string(w[p : p + k - 1], ' ') AS g
                         FROM (SELECT *, unnest(generate_series(1, len(w) - k + 1)) AS p FROM sized)),
             sizes AS (SELECT DISTINCT k FROM windows),
             grams AS (SELECT doc_id, k, p, array_to_string(w[p : p + k - 1], ' ') AS g
                       FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS p FROM d, sizes WHERE len(w) >= k)),
             hits AS (SELECT doc_id, item_id, k, p FROM grams JOIN windows USING (k, g)),
             places AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(generate_series(p, p + k - 1)) AS q FROM hits) GROUP BY doc_id),
             items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
                       FROM hits GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op11_lexical_search": """
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
             i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t FROM benchmark),
             s AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
             f AS (SELECT r, doc_id, n, t, count(*)::BIGINT AS tf FROM (SELECT r, doc_id, len(w)::BIGINT AS n, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM i) GROUP BY ALL),
             g AS (SELECT t, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS wt FROM f, s GROUP BY t),
             p AS (SELECT r, doc_id, t, wt * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))) AS x FROM f JOIN g USING (t), s),
             z AS (SELECT item_id, r, doc_id, sum(x)::BIGINT AS score FROM p JOIN i USING (t) GROUP BY item_id, r, doc_id HAVING sum(x) > 0),
             o AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM z)
        SELECT * FROM o WHERE rank <= 50""",
    "op13_hard_negatives": """
        WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
                   FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
                     AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
             p AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS vec_id, list_inner_product(a.v, b.v)::BIGINT AS score
                   FROM e a, e b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
             pos AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS k FROM p WHERE same) WHERE k <= 5),
             neg AS (SELECT pos.anchor_id, pos.vec_id AS positive_id, p.vec_id AS negative_id, pos.score AS positive_score, p.score AS negative_score,
                            row_number() OVER (PARTITION BY pos.anchor_id, pos.vec_id ORDER BY p.score DESC, p.vec_id)::INTEGER AS rank
                     FROM pos JOIN p ON p.anchor_id = pos.anchor_id AND NOT p.same AND 50 * pos.score <= 100 * p.score AND 100 * p.score <= 95 * pos.score)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 3""",
}
