"""Quality rules: text shape, repetition, and divergence from the language's usual histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from milepost.llm.common import SPACE, let, saved, words

#: Characters of a text by class; what is left of its words is plain lower-case letters.
CLASSES = {
    "upper": r"[A-Z]+",
    "digit": r"[0-9]+",
    "wide": r"[^\x00-\x7F]+",
    "symbol": r"[#*$%&|<>]+",
    "mark": r"[!\"'()+,./:;=?@\[\]^_`{}~\\-]+",
}
#: Characters of no class above: plain letters and white space.
UNCLASSED = r"[a-z\x20\x09-\x0D]+"
HISTOGRAM = (*CLASSES, "plain", "space")
MIN_WORDS = 50


def _repeated(text_words: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more, the first included.

    Windows are compared by a 64-bit hash. Only if two are equal are they sorted by it, so that equal ones are neighbours.
    """

    def hashes(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def windows(h: Column) -> Column:
        return F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))

    def twice(s: Column) -> Column:
        return F.filter(s, lambda x, k: (x.h == F.get(s, k - 1).h) | (x.h == F.get(s, k + 1).h))

    def covered(found: Column) -> Column:
        start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
        return F.aggregate(
            F.sort_array(F.transform(found, lambda x: x["at"])),
            start,
            lambda a, p: F.struct((a.n + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")),
            lambda a: a.n,
        )

    def repeats(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(let(windows(h), lambda s: covered(twice(s))))

    count = let(text_words, lambda w: let(hashes(w), repeats))
    return F.when(F.size(text_words) < 3, 0).otherwise(count).cast("long")


def _cut(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def base(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, text_key``, the word counts, character classes and ``base_failed``."""
    text = F.col("text")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = (
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("lang").cast("string").alias("lang"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        )
        .withColumn("w", words(text))
        .withColumn("n_words", F.size("w").cast("long"))
        .withColumn("word_chars", F.length(F.array_join("w", "")).cast("long"))
        # What is left for the classes is a few per cent of a text, gone through once a class.
        .withColumn("classed", F.regexp_replace(text, UNCLASSED, ""))
    )
    classed = F.col("classed")
    rows = rows.select(
        "doc_id",
        "lang",
        F.xxhash64("text").alias("text_key"),
        "n_words",
        "word_chars",
        _cut(classed, CLASSES["symbol"]).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _repeated(F.col("w")).alias("n_repeat_words"),
        (F.length(text) - F.col("word_chars")).cast("long").alias("space"),
        *[_cut(classed, CLASSES[c]).cast("long").alias(c) for c in CLASSES],
    )
    rest = F.col("word_chars") - sum((F.col(c) for c in CLASSES), F.lit(0))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.withColumn("plain", rest.cast("long")).withColumn("base_failed", failed)


def _term(p: Column, q: Column) -> Column:
    """One bin's part of twice the Jensen-Shannon divergence, in bits."""
    m = (p + q) / 2
    part = lambda x: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    return part(p) + part(q)


def _distance(total: Column) -> Column:
    return F.when(total.isNotNull(), F.sqrt(F.greatest(total / 2, F.lit(0.0))))


def _lower_words(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    word = F.explode(words(F.lower(text))).alias("word")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.xxhash64(text).alias("text_key"),
        word,
    )


def common_words(docs: DataFrame, n: int) -> DataFrame:
    """``word_no, lang, word, c, total``: the ``n`` most frequent words of each language, their counts and that of all its words."""
    counts = _lower_words(docs).groupBy("lang", "word").agg(F.count("*").alias("c"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("c").desc(), "word"))
    total = counts.groupBy(F.col("lang").alias("of")).agg(F.sum("c").alias("total"))
    ranked = counts.withColumn("rank", rank).where(F.col("rank") <= n)
    return ranked.join(total, F.col("lang").eqNullSafe(F.col("of"))).select(
        F.monotonically_increasing_id().alias("word_no"), "lang", "word", "c", "total"
    )


def quality(
    docs: DataFrame,
    max_class_distance: float = 0.30,
    max_word_distance: float = 0.48,
    min_chars: int = 200,
    min_words: int = MIN_WORDS,
    vocabulary: int = 50,
) -> DataFrame:
    """One row per document: the base counts, ``base_failed``, ``kept`` and the two distances.

    A document that passes the base rules stays if the Jensen-Shannon distance (0 to 1) of its
    character classes, and that of its common words, to those of its language are within the
    limits. Texts below ``min_chars`` or ``min_words`` are not judged by that histogram. The
    references are counted over all documents of the language (null is a language): classes
    over those that pass the base rules, the ``vocabulary`` most frequent words over all. A
    null text has no words, fails and has no distance. Documents with one ``doc_id`` and one text come out
    alike, as often as they are there. An empty table gives no rows; other columns are ignored.

    Words are exploded twice and shuffled only as counts: once per language and word, once per
    document and common word.
    """
    rows = saved(base(docs), "quality_base")
    sums = [F.sum(c).cast("double").alias(f"ref_{c}") for c in HISTOGRAM]
    passing = rows.where(~F.col("base_failed"))
    usual = saved(passing.groupBy(F.col("lang").alias("of")).agg(*sums), "quality_classes")
    frequent = saved(common_words(docs, vocabulary), "quality_words")

    chars = sum((F.col(c) for c in HISTOGRAM), F.lit(0))
    ref_chars = sum((F.col(f"ref_{c}") for c in HISTOGRAM), F.lit(0.0))
    shape = sum((_term(F.col(c) / F.col("chars"), F.col(f"ref_{c}") / F.col("ref_chars")) for c in HISTOGRAM), F.lit(0.0))

    # Common words that a document lacks add their share; their sum is the language's total. Counts are summed, not
    # shares, so that no order of a sum leaves a distance where there is none.
    known = frequent.select(F.col("lang").alias("of"), F.col("word").alias("common"), "word_no")
    counted = (
        _lower_words(docs)
        .join(known, F.col("lang").eqNullSafe(F.col("of")) & (F.col("word") == F.col("common")))
        .groupBy("doc_id", "text_key", "word_no")
        .agg(F.count("*").alias("c"))
        .join(frequent.select("word_no", "lang", F.col("c").alias("usual_c"), "total"), "word_no")
    )
    copies = rows.groupBy("doc_id", "text_key", "lang").agg(
        F.count("*").alias("copies"), F.first("n_words").alias("n")
    )
    seen = [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in ("doc_id", "text_key", "lang")]
    found = (
        copies.alias("x")
        .join(counted.alias("y"), seen[0] & seen[1] & seen[2])
        .select(
            *[f"x.{c}" for c in ("doc_id", "text_key", "lang")],
            "usual_c",
            (F.col("usual_c") / F.col("total")).alias("share"),
            (F.col("c") / F.col("copies")).cast("long").alias("own_c"),
            "n",
        )
        .groupBy("doc_id", "text_key", "lang")
        .agg(
            F.sum(_term(F.col("own_c") / F.col("n"), F.col("share"))).alias("present"),
            F.sum("usual_c").alias("present_c"),
            F.sum("own_c").alias("own_c"),
        )
    )
    totals = frequent.groupBy(F.col("lang").alias("total_of")).agg(F.sum("c").alias("lang_c"), F.first("total").alias("total"))
    present = F.coalesce("present", F.lit(0.0))
    absent = (F.col("lang_c") - F.coalesce("present_c", F.lit(0))) / F.col("total")
    other = _term(
        (F.col("n_words") - F.coalesce("own_c", F.lit(0))) / F.col("n_words"), (F.col("total") - F.col("lang_c")) / F.col("total")
    )

    joined = (
        rows.alias("x")
        .join(found.alias("y"), seen[0] & seen[1] & seen[2], "left")
        .select("x.*", "present", "present_c", "own_c")
        .join(usual, F.col("lang").eqNullSafe(F.col("of")), "left")
        .join(totals, F.col("lang").eqNullSafe(F.col("total_of")), "left")
        .withColumn("chars", chars.cast("double"))
        .withColumn("ref_chars", ref_chars)
        .withColumn("class_distance", F.when(F.col("chars") > 0, _distance(shape)))
        .withColumn("word_distance", F.when(F.col("n_words") > 0, _distance(present + absent + other)))
    )
    odd = ((F.col("chars") >= min_chars) & (F.coalesce("class_distance", F.lit(0.0)) > max_class_distance)) | (
        (F.col("n_words") >= min_words) & (F.coalesce("word_distance", F.lit(0.0)) > max_word_distance)
    )
    return joined.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & ~odd).alias("kept"),
        "class_distance",
        "word_distance",
    )


#: The contract's columns, written from the definitions.
QUALITY_SQL = r"""
WITH t AS (
  SELECT doc_id, lang, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), b AS (
  SELECT *, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(text) AS n_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         length(regexp_replace(text, '[^A-Z]+', '', 'g')) AS n_upper,
         length(regexp_replace(text, '[^0-9]+', '', 'g')) AS n_digit,
         length(regexp_replace(text, '[\x00-\x7F]+', '', 'g')) AS n_wide,
         length(regexp_replace(text, '[^!"''()+,./:;=?@\[\]^_`{}~\\-]+', '', 'g')) AS n_mark
  FROM t
), grams AS (
  SELECT doc_id, unnest(w[:-3]) AS w1, unnest(w[2:-2]) AS w2, unnest(w[3:]) AS w3,
         unnest(range(1, n_words - 1)) AS i
  FROM (SELECT * FROM b WHERE n_words >= 3)
), often AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w1, w2, w3) AS n FROM grams
), gaps AS (
  SELECT doc_id, least(3, i - lag(i, 1, -9) OVER (PARTITION BY doc_id ORDER BY i)) AS step FROM often WHERE n > 1
), r AS (
  SELECT doc_id, sum(step) AS n_repeat_words FROM gaps GROUP BY doc_id
), m AS (
  SELECT b.*, coalesce(r.n_repeat_words, 0) AS n_repeat_words,
         n_words < 50 OR 100 * coalesce(r.n_repeat_words, 0) > 50 * n_words AS base_failed
  FROM b LEFT JOIN r USING (doc_id)
), classes AS (
  SELECT doc_id, lang, base_failed, n_chars, unnest(['u', 'd', 'w', 's', 'm', 'p', 'b']) AS class,
         unnest([n_upper, n_digit, n_wide, n_symbols, n_mark,
                 word_chars - n_upper - n_digit - n_wide - n_symbols - n_mark, n_chars - word_chars]) AS c
  FROM m
), usual AS (
  SELECT lang, class, sum(c) / sum(sum(c)) OVER (PARTITION BY lang) AS q
  FROM classes WHERE NOT base_failed GROUP BY lang, class
), shape AS (
  SELECT doc_id, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
                   + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2 AS jsd
  FROM (SELECT c.doc_id, c.c / n_chars AS p, u.q FROM classes c JOIN usual u USING (lang, class) WHERE n_chars > 0)
  GROUP BY doc_id
), tokens AS (
  SELECT doc_id, lang, lower(unnest(w)) AS word FROM t
), top AS (
  SELECT * FROM (
    SELECT lang, word, count(*) / sum(count(*)) OVER (PARTITION BY lang) AS q,
           row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) AS k
    FROM tokens GROUP BY lang, word) WHERE k <= 50
), known AS (
  SELECT doc_id, lang, word, count(*) AS c FROM tokens SEMI JOIN top USING (lang, word) GROUP BY doc_id, lang, word
), bins AS (
  SELECT m.doc_id, coalesce(k.c, 0) / m.n_words AS p, top.q
  FROM m JOIN top USING (lang) LEFT JOIN known k ON k.doc_id = m.doc_id AND k.word = top.word WHERE m.n_words > 0
  UNION ALL
  SELECT m.doc_id, 1 - coalesce((SELECT sum(k.c) FROM known k WHERE k.doc_id = m.doc_id), 0) / m.n_words,
         1 - (SELECT sum(top.q) FROM top WHERE top.lang = m.lang) FROM m WHERE m.n_words > 0
), spoken AS (
  SELECT doc_id, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
                   + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2 AS jsd
  FROM bins GROUP BY doc_id
)
SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND NOT (n_chars >= 200 AND coalesce(sqrt(greatest(s.jsd, 0)), 0) > 0.30)
                       AND NOT (n_words >= 50 AND coalesce(sqrt(greatest(v.jsd, 0)), 0) > 0.48) AS kept
FROM m LEFT JOIN shape s USING (doc_id) LEFT JOIN spoken v USING (doc_id)
"""
