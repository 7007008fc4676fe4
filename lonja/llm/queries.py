"""The registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lonja.llm.alignment import link_report
from lonja.llm.curriculum import mixture
from lonja.llm.decontaminate import contamination
from lonja.llm.exact_dedup import exact_duplicates
from lonja.llm.filter_audit import audit
from lonja.llm.near_join import near_duplicates
from lonja.llm import language, packing, quality
from lonja.llm.repeats import repeated_spans
from lonja.llm.rows import table
from lonja.llm.secret_scan import scan
from lonja.llm.token_files import round_trip
from lonja.llm.topk import top_inner_products


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(table(spark, sf_dir, "documents")).drop("spans")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    dictionaries = language.train(docs.where(~language.held_out()))
    return language.identify(docs.select("doc_id", "text"), dictionaries).select(
        "doc_id", language.held_out().alias("held_out"), F.col("lang_best").alias("lang_pred"),
        F.col("lang_score").alias("score"), F.col("lang_rejected").alias("rejected"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_inner_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixture(table(spark, sf_dir, "documents"))
    texts = F.transform("positions", lambda p: F.round(p, 6).cast("decimal(9,6)").cast("string"))
    return mixed.withColumn("positions", F.array_join(texts, ","))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_report(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


LLM_QUERIES = {
    "op1_suffix_array_dedup": op1_suffix_array_dedup,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_token_files": op3_token_files,
    "op4_ngram_join": op4_ngram_join,
    "op5_language": op5_language,
    "op6_secret_scan": op6_secret_scan,
    "op7_top_k": op7_top_k,
    "op8_mix_sources": op8_mix_sources,
    "op9_quality": op9_quality,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_token_alignment": op11_token_alignment,
    "op12_filter_audit": op12_filter_audit,
    "op13_decontaminate": op13_decontaminate,
}

LLM_ORACLE = {
    "op1_suffix_array_dedup": """
        WITH docs AS (SELECT row_number() OVER () AS row, doc_id, hex(coalesce(text, '')) AS bytes FROM documents),
        starts AS (SELECT row, bytes, unnest(range(1, greatest(len(bytes) // 2 - 199, 0) + 1)) AS spot FROM docs),
        marks AS (SELECT row, spot, md5(substr(bytes, 2 * spot - 1, 400)) AS mark FROM starts),
        hits AS (SELECT row, spot FROM marks JOIN (SELECT mark FROM marks GROUP BY mark HAVING count(*) > 1) USING (mark)),
        -- A start begins a span unless it touches what the one before it covers.
        heads AS (SELECT row, spot, (spot <= coalesce(lag(spot) OVER (PARTITION BY row ORDER BY spot), -999) + 200)::INTEGER AS goes_on FROM hits),
        numbered AS (SELECT row, spot, sum(1 - goes_on) OVER (PARTITION BY row ORDER BY spot) AS span FROM heads),
        spans AS (SELECT row, min(spot) AS low, max(spot) + 200 AS high FROM numbered GROUP BY row, span),
        totals AS (SELECT row, sum(high - low)::BIGINT AS n_removed, count(*) AS n_spans FROM spans GROUP BY row),
        gaps AS (
          SELECT row, lag(high, 1, 1) OVER (PARTITION BY row ORDER BY low) AS low, low AS high FROM spans UNION ALL
          SELECT row, max(high), NULL FROM spans GROUP BY row),
        kept AS (
          SELECT row, string_agg(substr(bytes, 2 * low - 1, coalesce(2 * (high - low), len(bytes))), '' ORDER BY low) AS rest
          FROM gaps JOIN docs USING (row) GROUP BY row)
        SELECT doc_id, len(bytes) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
               sha256(unhex(coalesce(rest, bytes))) AS kept_sha256
        FROM docs LEFT JOIN totals USING (row) LEFT JOIN kept USING (row)""",
    "op2_exact_dedup": r"""
        WITH plain AS (
          SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
          FROM documents),
        groups AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM plain GROUP BY text_sha256)
        SELECT doc_id, keep_id, group_size,
               doc_id IS NOT DISTINCT FROM keep_id
                 AND row_number() OVER (PARTITION BY text_sha256, doc_id) = 1 AS kept, text_sha256
        FROM plain JOIN groups USING (text_sha256)""",
    "op7_top_k": """
        WITH vectors AS (
          SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
          WHERE embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
        scores AS (
          SELECT q.vec_id AS query_id, d.vec_id, list_dot_product(q.v, d.v)::BIGINT AS score
          FROM vectors q JOIN vectors d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id),
        ranked AS (
          SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM scores)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op8_mix_sources": r"""
        WITH sizes AS (
          SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, ' ' || coalesce(text, ''))) AS key,
                 CASE WHEN text IS NULL THEN 0
                      ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size FROM documents),
        sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
        weighted AS (
          SELECT source, source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS place,
                 [5, 2, 1][1 + place] AS weight FROM sources),
        levels AS (
          SELECT *, row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS turn,
                 (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0))
                    / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
          FROM weighted WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        final AS (SELECT arg_min(level, turn) FILTER (WHERE 3 * source_size > level * weight) AS level FROM levels),
        aims AS (
          SELECT w.source, source_size, place,
                 CASE WHEN f.level IS NULL OR 3 * source_size <= f.level * weight THEN (3 * source_size)::DOUBLE
                      ELSE f.level * weight END AS target
          FROM weighted w, final f),
        placed AS (
          SELECT s.doc_id, s.size, a.source_size, a.target, a.place,
                 least(floor(a.target + 0.5), 3 * a.source_size)::BIGINT AS demand,
                 coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.size
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
          FROM sizes s JOIN aims a ON s.source IS NOT DISTINCT FROM a.source),
        taken AS (
          SELECT *, list_transform([0, 1, 2], lambda e: greatest(least(demand - before - e * source_size, size), 0)) AS words FROM placed),
        -- The part of the demand before the middle of each copy that is used, then the time at which the integral of the
        -- source's rate of use gets there. Rates: 1.5 until 0.3, down to 0.5 at 0.8; even; 0.5 until 0.5, up to 2 at 1.
        parts AS (
          SELECT *, list_transform(list_filter([0, 1, 2], lambda e: words[e + 1] > 0),
                                   lambda e: (before + e * source_size + words[e + 1] / 2.0) / demand::DOUBLE) AS part FROM taken),
        timed AS (
          SELECT *, list_transform(part, lambda p: CASE
                   WHEN place = 1 THEN p
                   WHEN place = 0 AND p * 1.05 <= 0.45 THEN p * 1.05 / 1.5
                   WHEN place = 0 AND p * 1.05 <= 0.95 THEN 0.3 + (1.5 - sqrt(greatest(2.25 - 4 * (p * 1.05 - 0.45), 0))) / 2
                   WHEN place = 0 THEN 0.8 + (p * 1.05 - 0.95) / 0.5
                   WHEN p * 0.875 <= 0.25 THEN p * 0.875 / 0.5
                   ELSE 0.5 + (sqrt(0.25 + 6 * (p * 0.875 - 0.25)) - 0.5) / 3 END) AS times FROM parts)
        SELECT doc_id, size, source_size, target, list_sum(words)::BIGINT AS taken, len(part)::INTEGER AS epochs,
               coalesce(array_to_string(list_transform(times, lambda t: round(t, 6)::DECIMAL(9, 6)::VARCHAR), ','), '') AS positions
        FROM timed""",
    "op12_filter_audit": r"""
        WITH marked AS (
          SELECT doc_id, max((quality = 1)::INTEGER) AS good, max((toxic = 1)::INTEGER) AS toxic FROM labels GROUP BY doc_id),
        texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
        counted AS (
          SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS least FROM texts),
        judged AS (
          SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                 (len(words) < 200)::INTEGER + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INTEGER
                 + 4 * (100 * len(regexp_extract_all(text, '[A-Z]')) > 2 * length(text))::INTEGER
                 + 8 * regexp_matches(text, '[#$%&*|]')::INTEGER + 16 * coalesce(least < doc_id, false)::INTEGER AS mask
          FROM counted LEFT JOIN marked USING (doc_id)),
        masks AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY ALL),
        letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
        orders AS (
          SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
          WHERE b.f <> a.f AND c.f NOT IN (a.f, b.f) AND d.f NOT IN (a.f, b.f, c.f) AND e.f NOT IN (a.f, b.f, c.f, d.f)),
        places AS (SELECT filter_order, unnest(range(1, 6))::INTEGER AS step FROM orders),
        steps AS (
          SELECT *, (1 << (strpos('ABCDE', filter_order[step]) - 1)::INTEGER) AS bit,
                 coalesce(list_sum(list_transform(range(1, step), lambda k: 1 << (strpos('ABCDE', filter_order[k]) - 1)::INTEGER)), 0)::INTEGER
                   AS before
          FROM places),
        applied AS (
          SELECT part, filter_order, step, bit,
                 coalesce(sum(n) FILTER (WHERE mask & (before | bit) = 0), 0)::BIGINT AS kept,
                 coalesce(sum(n) FILTER (WHERE mask & bit > 0 AND mask & before = 0), 0)::BIGINT AS removed,
                 coalesce(sum(n) FILTER (WHERE mask & bit > 0 AND mask & before > 0), 0)::BIGINT AS redundant,
                 coalesce(sum(n) FILTER (WHERE mask = bit), 0)::BIGINT AS unique_fails,
                 coalesce(sum(good) FILTER (WHERE mask & bit > 0 AND mask & before = 0), 0)::BIGINT AS good_lost,
                 coalesce(sum(toxic) FILTER (WHERE mask & bit > 0 AND mask & before = 0), 0)::BIGINT AS toxic_lost
          FROM masks, steps GROUP BY part, filter_order, step, bit)
        SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
               (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
        FROM applied""",
    "op13_decontaminate": r"""
        WITH docs AS (
          SELECT row_number() OVER () AS row, doc_id,
                 regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
        items AS (
          SELECT coalesce(item_id::VARCHAR, '') AS item,
                 regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
        places AS (
          SELECT item, words, least(10, len(words)) AS size, unnest(range(1, greatest(1, len(words) - 9) + 1)) AS spot
          FROM items WHERE len(words) > 0),
        windows AS (SELECT DISTINCT item, size, array_to_string(words[spot:spot + size - 1], ' ') AS gram FROM places),
        sizes AS (SELECT DISTINCT size FROM windows),
        starts AS (
          SELECT row, size, words, unnest(range(1, len(words) - size + 2)) AS spot FROM docs, sizes WHERE len(words) >= size),
        hits AS (
          SELECT s.row, s.spot, s.size, w.item FROM starts s
          JOIN windows w ON w.size = s.size AND w.gram = array_to_string(s.words[s.spot:s.spot + s.size - 1], ' ')),
        covered AS (
          SELECT row, count(DISTINCT word) AS n_hit FROM (SELECT row, unnest(range(spot, spot + size)) AS word FROM hits) GROUP BY row),
        named AS (SELECT row, list_sort(list(DISTINCT item)) AS names FROM hits GROUP BY row)
        SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
               coalesce(len(names), 0)::BIGINT AS n_items,
               sha256(coalesce(array_to_string(names, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs LEFT JOIN covered USING (row) LEFT JOIN named USING (row)""",
}
