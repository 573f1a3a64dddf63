"""One query per corpus operator, with production parameters, over the whole of its table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.class_lm import score_documents
from tidemart.llm.collocations import collocations
from tidemart.llm.common import fold, table
from tidemart.llm.decontamination import overlaps
from tidemart.llm.exact_dedup import DigestIndex
from tidemart.llm.lexical_search import lexical_search
from tidemart.llm.line_dedup import clean_pages
from tidemart.llm.main_text import main_texts
from tidemart.llm.mixing import Mix
from tidemart.llm.ngram_join import ngram_components
from tidemart.llm.paragraph_dedup import ParagraphDedup
from tidemart.llm.passage_dedup import PassageDedup
from tidemart.llm.quality import quality
from tidemart.llm.token_records import read_records, write_records
from tidemart.llm.toxicity import toxicity
from tidemart.session import scratch_dir

TOKENIZER = "byte_bpe_50k.json"


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against a new digest index."""
    index = DigestIndex.create(spark)
    rows = index.add(table(spark, sf_dir, "documents"), "documents")
    return rows.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with its lines counted and the digest of those that stay."""
    pages = clean_pages(spark, table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select(
        "page_id",
        "host",
        F.size("lines").cast("bigint").alias("n_lines"),
        F.size("kept").cast("bigint").alias("n_kept"),
        F.sha2(F.array_join("kept", "\n"), 256).alias("kept_sha256"),
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every contaminated document with each benchmark item that it holds."""
    found = overlaps(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.groupBy("doc_id", "item_id").agg(
        F.count(F.lit(1)).alias("n_overlaps"),
        F.max("best_window").alias("best_window"),
        F.max("n_equal").alias("n_equal"),
        F.min("doc_start").alias("first_token"),
    )


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality, learnt from the labels outside of fold 0 of 5."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scores, _ = quality(spark, docs, labels.where(fold(F.col("doc_id"), 5) != 0))
    return scores.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(True)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words that the mix takes of it."""
    mix = Mix(spark, table(spark, sf_dir, "documents"))
    return mix.counts().select("doc_id", "size", "source_size", "target", "taken", "source")


def op6_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of 50 words or more that repeats, nearly or exactly, wherever it lies."""
    return ParagraphDedup(spark, table(spark, sf_dir, "documents")).spans().drop("text_hash")


def op6_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of 50 words or more that repeats, inside lines or across them, and which of them stays."""
    return PassageDedup(spark, table(spark, sf_dir, "documents")).spans().drop("text_hash")


def op7_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document written as a token record and read back."""
    path = scratch_dir(spark, "token-records")
    write_records(table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER))
    return read_records(spark, path, digest=True)


def op8_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's probability, learnt from the texts outside of fold 2 of 7."""
    docs = table(spark, sf_dir, "documents")
    scores = score_documents(spark, docs, docs.where(fold(F.col("doc_id"), 7) != 2))
    return scores.withColumn("held_out", F.coalesce(fold(F.col("doc_id"), 7) == 2, F.lit(True))).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learnt from the labels outside of fold 1 of 3."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scores, _ = toxicity(spark, docs, labels.where(fold(F.col("doc_id"), 3) != 1))
    return scores.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(True)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose sets of 5-word shingles have a Jaccard similarity of at least 0.8, closed to components."""
    return ngram_components(spark, table(spark, sf_dir, "documents"), size=5, num=80, den=100)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2,000 best phrases."""
    return collocations(spark, table(spark, sf_dir, "documents"), min_count=100, keep_ratio=100, best=2000)


def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text, by weights learnt from all pages that name their article."""
    return main_texts(spark, table(spark, sf_dir, "pages"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents for each benchmark item."""
    return lexical_search(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


LLM_QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_line_dedup": op2_line_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_quality": op4_quality,
    "op5_mix_sources": op5_mix_sources,
    "op6_paragraph_dedup": op6_paragraph_dedup,
    "op6_passage_dedup": op6_passage_dedup,
    "op7_token_records": op7_token_records,
    "op8_class_lm": op8_class_lm,
    "op9_toxicity": op9_toxicity,
    "op10_ngram_join": op10_ngram_join,
    "op11_collocations": op11_collocations,
    "op12_main_text": op12_main_text,
    "op13_lexical_search": op13_lexical_search,
}

LLM_ORACLES = {
    "op1_exact_dedup": r"""
        WITH digests AS (
            SELECT doc_id,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g'))
                       AS text_sha256
            FROM documents)
        SELECT doc_id,
               min(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               coalesce(doc_id = min(doc_id) OVER same, false) AS kept,
               text_sha256
        FROM digests
        WINDOW same AS (PARTITION BY text_sha256)
    """,
    "op2_line_dedup": r"""
        WITH cut AS (
            SELECT row_number() OVER () AS page, page_id,
                   nullif(lower(regexp_extract(
                       url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '') AS host,
                   list_filter(
                       list_transform(
                           string_split_regex(
                               regexp_replace(regexp_replace(regexp_replace(
                                   coalesce(html, ''),
                                   '(?is)<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)|<!--.*?(?:-->|\z)', chr(10), 'g'),
                                   '(?i)</?(?:a|abbr|b|bdi|cite|code|em|font|i|kbd|mark|q|s|samp|small|span|strong|sub|sup|u|var|wbr)(?:\s[^<>]*)?>', '', 'g'),
                                   '<[^<>]*>', chr(10), 'g'),
                               '[\n\r]+'),
                           lambda l: trim(regexp_replace(l, '[\x20\x09-\x0D]+', ' ', 'g'))),
                       lambda l: l <> '') AS lines
            FROM pages),
        lines AS (
            SELECT page, host, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM cut),
        totals AS (SELECT host, count(*) AS pages FROM cut WHERE host IS NOT NULL GROUP BY host),
        common AS (
            SELECT host, line
            FROM (SELECT host, line, count(DISTINCT page) AS n FROM lines GROUP BY host, line)
                 JOIN totals USING (host)
            WHERE n >= 3 AND n > pages * 0.1::DOUBLE),
        kept AS (
            SELECT page, count(*) AS n, string_agg(line, chr(10) ORDER BY pos) AS text
            FROM lines ANTI JOIN common USING (host, line)
            GROUP BY page)
        SELECT page_id, host, len(lines) AS n_lines, coalesce(n, 0) AS n_kept,
               sha256(coalesce(text, '')) AS kept_sha256
        FROM cut LEFT JOIN kept USING (page)
    """,
    "op10_ngram_join": r"""
        WITH RECURSIVE tokens AS (
            SELECT doc_id,
                   regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, shingle
            FROM (
                SELECT doc_id,
                       unnest(CASE WHEN len(w) = 0 THEN []
                                   WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                                   ELSE list_transform(range(1, len(w) - 3),
                                            lambda k: array_to_string(w[k:k + 4], ' ')) END)
                           AS shingle
                FROM tokens)),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS i
            FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id),
        links AS (
            SELECT u, v
            FROM common JOIN sizes x ON u = x.doc_id JOIN sizes y ON v = y.doc_id
            WHERE 100 * i >= 80 * (x.n + y.n - i)),
        reach(doc_id, other) AS (
            SELECT doc_id, doc_id FROM documents
            UNION
            SELECT reach.doc_id, links.v FROM reach JOIN links ON links.u = reach.other)
        SELECT reach.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
        FROM reach LEFT JOIN sizes ON sizes.doc_id = reach.doc_id
        GROUP BY reach.doc_id
    """,
    "op11_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(regexp_split_to_array(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang),
        grams AS (
            SELECT lang, size,
                   unnest(list_transform(range(1, len(w) - size + 2), lambda k: array_to_string(w[k:k + size - 1], ' ')))
                       AS phrase
            FROM worded, (SELECT unnest([1, 2, 3, 4, 5]) AS size)),
        counts AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
        cuts AS (
            SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k
            FROM counts WHERE size > 1),
        scored AS (
            SELECT cuts.lang, cuts.phrase, a, h.f AS l, t.f AS r, n, k,
                   ((1000 * a::HUGEINT * n) // (h.f::HUGEINT * t.f))::BIGINT AS score
            FROM cuts
                 JOIN counts h ON h.lang = cuts.lang AND h.phrase = array_to_string(w[:k], ' ')
                 JOIN counts t ON t.lang = cuts.lang AND t.phrase = array_to_string(w[k + 1:], ' ')
                 JOIN totals ON totals.lang = cuts.lang),
        lowest AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        parts AS (
            SELECT lang, f, array_to_string(string_split(phrase, ' ')[i:i + m - 1], ' ') AS phrase
            FROM counts, (SELECT unnest(range(2, 5)) AS m), (SELECT unnest(range(1, 5)) AS i)
            WHERE m < size AND i + m - 1 <= size),
        longer AS (SELECT lang, phrase, max(f) AS f FROM parts GROUP BY lang, phrase),
        kept AS (
            SELECT lowest.* FROM lowest LEFT JOIN longer USING (lang, phrase)
            WHERE longer.f IS NULL OR 100 * longer.f < 100 * a)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
               phrase, a, l, r, n, score
        FROM kept
        QUALIFY rank <= 2000
    """,
    "op13_lexical_search": r"""
        WITH doc_terms AS (
            SELECT row_number() OVER () AS doc, doc_id,
                   regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents),
        item_terms AS (
            SELECT row_number() OVER () AS item, item_id,
                   unnest(regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark),
        asked AS (SELECT item, item_id, term, count(*) AS times FROM item_terms GROUP BY ALL),
        whole AS (SELECT count(*) AS docs, sum(len(terms))::BIGINT AS total FROM doc_terms WHERE len(terms) > 0),
        found AS (
            SELECT doc, doc_id, n, term, count(*) AS tf
            FROM (SELECT doc, doc_id, len(terms) AS n, unnest(terms) AS term FROM doc_terms)
            GROUP BY ALL),
        weights AS (
            SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
            FROM (SELECT term, count(*) AS df FROM found GROUP BY term), whole),
        scores AS (
            SELECT item, item_id, doc_id, doc,
                   sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total))))::BIGINT
                       AS score
            FROM asked JOIN weights USING (term) JOIN found USING (term), whole
            GROUP BY ALL)
        SELECT item_id, rank::INTEGER AS rank, doc_id, score
        FROM (
            SELECT item_id, doc_id, score,
                   row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank
            FROM scores WHERE score > 0)
        WHERE rank <= 20
    """,
}
