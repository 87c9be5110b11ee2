"""Near-duplicate lines by a deletion-neighbourhood join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from milepost.llm.common import WHITE, Scratch, let, saved, words

#: Lines of fewer words are duplicates only if they are equal.
MIN_WORDS = 8


def _text(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, text``: rows with one id and one text count as one document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text")
    )


def _halves(h: Column) -> Column:
    """``last, half``: hashes of the first and of the last words of a line, given its words' hashes.

    Of two lines one edit apart, both keep their first or their last ``(n - 1) // 2`` words,
    where n is the shorter length; a line gives the keys for its own length and one less.
    """

    def keys(m: Column) -> Column:
        return F.array(
            F.struct(F.lit(False).alias("last"), F.xxhash64(F.lit(1), m, F.slice(h, 1, m)).alias("half")),
            F.struct(F.lit(True).alias("last"), F.xxhash64(F.lit(2), m, F.slice(h, F.size(h) - m + 1, m)).alias("half")),
        )

    own, less = (F.floor((F.size(h) - k) / 2).cast("int") for k in (1, 2))
    return F.when(own == less, keys(own)).otherwise(F.concat(keys(own), keys(less)))


def _hashes(w: Column) -> Column:
    return F.transform(w, lambda x: F.xxhash64(x))


def lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per line with a word: its place, a 128-bit key of its words, and the keys of its halves."""
    split = _text(docs).select("doc_id", "text_key", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    # Tested on the text: a filter on the words would split every line twice.
    filled = split.where(F.btrim("line", F.lit(WHITE)) != "")
    with_words = filled.select("doc_id", "text_key", "line_no", words(F.col("line")).alias("w"))

    def keys(h: Column) -> Column:
        key = F.struct(F.xxhash64(h).alias("h"), F.xxhash64(F.lit(1), h).alias("g"))
        return F.struct(key.alias("line_key"), F.when(F.size(h) >= min_words, _halves(h)).alias("halves"))

    return with_words.select(
        F.struct("doc_id", "text_key", "line_no").alias("place"), let(_hashes(F.col("w")), keys).alias("k")
    ).select("place", "k.line_key", "k.halves")


def _variants(candidates: DataFrame) -> DataFrame:
    """``place, at, variant``: lines with one word deleted, and lines themselves, as 128-bit keys.

    ``at`` is the place of the deleted word, and -1 for the line itself. A line that shares its first
    words with another (``first``) loses one of the later words, one that shares its last words
    (``last``) one of the earlier.

    The hash of a word list is that of each word with its position, all joined by exclusive or. So a
    deletion's hash is that of the words before, and that of the words after moved up by one: two
    running values over the words as rows.
    """
    seeds = (1, 2)

    def joined(h: Column, seed: int, up: int) -> Column:
        """Of all words, where they are or moved ``up``."""
        hashed = F.transform(h, lambda x, i: F.xxhash64(x, i - up, F.lit(seed)))
        return F.aggregate(hashed, F.lit(0).cast("long"), lambda x, y: x.bitwiseXOR(y))

    def numbered(h: Column) -> Column:
        # Length and totals are inside, so that the list itself does not go with each of its words.
        def rows(line: Column) -> Column:
            return F.transform(h, lambda x, i: F.struct(i.alias("at"), x.alias("x"), line.alias("whole")))

        totals = [joined(h, s, up).alias(f"{k}{s}") for s in seeds for k, up in (("a", 0), ("b", 1))]
        return let(F.struct(F.size(h).alias("n"), *totals), rows)

    rows = candidates.repartition("line_key").select(
        "line_key", "place", "first", "last", F.inline(let(_hashes(F.col("w")), numbered))
    )
    n = F.col("whole.n")
    hashed = rows.withColumns({f"a{s}": F.xxhash64("x", "at", F.lit(s)) for s in seeds}).withColumns(
        {f"b{s}": F.xxhash64("x", F.col("at") - 1, F.lit(s)) for s in seeds}
    )
    # Up to a word and with it: where the words are, less what they are moved up by one.
    so_far = Window.partitionBy("line_key").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = hashed.withColumns(
        {f"to{s}": F.bit_xor(F.col(f"a{s}").bitwiseXOR(F.col(f"b{s}"))).over(so_far) for s in seeds}
    )
    without = [F.col(f"to{s}").bitwiseXOR(F.col(f"a{s}")).bitwiseXOR(F.col(f"whole.b{s}")).alias(f"h{s}") for s in seeds]
    itself = [F.col(f"whole.a{s}").alias(f"h{s}") for s in seeds]
    half = F.floor((n - 2) / 2)
    lost = (F.col("first") & (F.col("at") >= half)) | (F.col("last") & (F.col("at") < n - half))
    found = F.array(
        F.struct(F.when(lost, F.col("at")).alias("at"), F.struct(*without).alias("variant")),
        # Once a line.
        F.struct(F.when(F.col("at") == 0, F.lit(-1)).alias("at"), F.struct(*itself).alias("variant")),
    )
    return running.select("place", F.inline(found)).where("at IS NOT NULL")


def _within_one(a: Column, b: Column) -> Column:
    """Do two word lists differ by one inserted, deleted or replaced word, or not at all?"""

    def after(long: Column, short: Column) -> Column:
        same = F.array_position(F.zip_with(long, short, lambda x, y: x.eqNullSafe(y)), F.lit(False)).cast("int")
        rest_short = F.when(F.size(long) == F.size(short), same + 1).otherwise(same)
        tail = lambda x, at: F.slice(x, at, F.size(x) + 1)
        return F.when(same == 0, True).otherwise(tail(long, same + 1) == tail(short, rest_short))

    return (
        F.when(F.abs(F.size(a) - F.size(b)) > 1, False)
        .when(F.size(a) >= F.size(b), after(a, b))
        .otherwise(after(b, a))
    )


def _fates(found: DataFrame, docs: DataFrame) -> DataFrame:
    """``line_key, first, near``: lines that stand more than once, or within one word edit of an earlier line."""
    with Scratch(docs.sparkSession) as scratch:
        earliest = found.groupBy("line_key").agg(
            F.min("place").alias("place"), F.first("halves").alias("halves"), F.count("*").alias("n")
        )
        distinct = scratch.saved(earliest.withColumn("line", F.monotonically_increasing_id()), "lines_first")
        halves = distinct.where("halves IS NOT NULL").select("line", F.inline("halves"))
        shared = halves.groupBy("half").agg(F.count("*").alias("n")).where("n > 1").select("half")
        sharing = halves.join(shared, "half", "left_semi").groupBy("line")
        sides = sharing.agg(F.bool_or(~F.col("last")).alias("first"), F.bool_or("last").alias("last"))
        # The words of candidate lines only, from their first places.
        by_text = (
            distinct.drop("halves", "n")
            .join(sides, "line")
            .groupBy(F.col("place.doc_id").alias("id"), F.col("place.text_key").alias("key"))
            .agg(F.collect_list(F.struct("line_key", "place", "first", "last")).alias("wanted"))
        )
        text = _text(docs)
        candidates = scratch.saved(
            by_text.join(text, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("text_key")))
            .select("wanted", F.split("text", "\n").alias("all_lines"))
            .select("all_lines", F.explode("wanted").alias("x"))
            .select("x.*", words(F.get("all_lines", F.col("x.place.line_no"))).alias("w"))
            .dropDuplicates(["line_key"]),
            "line_candidates",
        )
        near = _near(candidates, scratch.saved(_variants(candidates), "line_variants")).withColumn("near", F.lit(True))
        fates = distinct.select("line_key", F.col("place").alias("first"), "n").join(near, "line_key", "left")
        return saved(fates.where("n > 1 OR near").drop("n"), "line_fates")


def _near(candidates: DataFrame, variants: DataFrame) -> DataFrame:
    # Lines with one word replaced meet at equal place and variant, lines with one inserted at
    # the variant that is the shorter line. Each links to the earliest it meets: no pairs.
    deleted = variants.where("at >= 0")
    replaced = deleted.groupBy("variant", "at").agg(F.min("place").alias("earliest"), F.count("*").alias("n")).where("n > 1")
    links_replaced = deleted.join(replaced.drop("n"), ["variant", "at"]).where("earliest < place")
    whole = variants.where("at = -1").select("variant", F.col("place").alias("whole"))
    inserted = deleted.join(whole, "variant")
    longer = inserted.where("whole < place").select("place", F.col("whole").alias("earliest"))
    shorter = (
        inserted.where("place < whole")
        .groupBy("whole")
        .agg(F.min("place").alias("earliest"))
        .select(F.col("whole").alias("place"), "earliest")
    )
    links = links_replaced.select("place", "earliest").unionByName(longer).unionByName(shorter).distinct()
    other = candidates.select(F.col("place").alias("earliest"), F.col("w").alias("v"))
    return (
        links.join(candidates, "place")
        .join(other, "earliest")
        .where(_within_one(F.col("w"), F.col("v")))
        .select("line_key")
        .distinct()
    )


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with duplicate lines taken out of ``text``; two counts are added.

    A line is a duplicate if a line with the same words stands earlier (smaller ``doc_id``,
    then line number; null ids first), or, if both have ``min_words`` words or more, one within
    one inserted, deleted or replaced word of it, whether or not that one stays. Lines without a
    word stay. ``n_exact_lines`` and ``n_near_lines`` count what was removed; columns of
    these names that are there already are replaced, all others are kept. A null text stays
    null; a text whose lines all go becomes empty, but its document stays. Rows with one id and
    one text are one document and come out alike. An empty table gives no rows.

    Only keys of lines are shuffled to find equal lines. Near-duplicates share their first or
    last words; only lines that share these with another get their deletion variants. A variant
    met by many lines is a count and a minimum, so no task holds its lines.
    """
    found = saved(lines(docs, min_words), "lines")
    fates = _fates(found, docs)
    gone = (
        found.select("line_key", "place")
        .join(fates, "line_key")
        .where(F.col("near") | (F.col("place") > F.col("first")))
        .groupBy(F.col("place.doc_id").alias("gone_id"), F.col("place.text_key").alias("gone_key"))
        .agg(
            F.collect_set("place.line_no").alias("gone_lines"),
            F.collect_set(F.when(F.col("place") > F.col("first"), F.col("place.line_no"))).alias("gone_exact"),
        )
    )
    # The given columns stay inside one, so that no name clashes with those of the join.
    names = [c for c in docs.columns if c not in ("n_exact_lines", "n_near_lines")]
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"),
        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("doc_key"),
    )
    same = F.col("doc.doc_id").cast("long").eqNullSafe(F.col("gone_id")) & (F.col("doc_key") == F.col("gone_key"))
    kept = lambda x: F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col("gone_lines"))
    rest = let(
        F.split("doc.text", "\n"), lambda x: F.array_join(F.transform(kept(x), lambda i: F.get(x, i)), "\n")
    )
    some = F.col("gone_lines").isNotNull()
    n_gone, n_exact = (F.when(some, F.size(c)).otherwise(0).cast("long") for c in ("gone_lines", "gone_exact"))
    return keyed.join(gone, same, "left").select(
        *[
            F.when(some, rest).otherwise(F.col("doc.text")).alias("text") if c == "text" else F.col(f"doc.`{c}`").alias(c)
            for c in names
        ],
        n_exact.alias("n_exact_lines"),
        (n_gone - n_exact).alias("n_near_lines"),
    )
