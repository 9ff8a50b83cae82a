"""Document fingerprints: bottom-k sketches of shingle hashes, as built-in functions on arrays.

A sketch holds the K least distinct 48-bit hashes of a text's five-word shingles. Sketches of parts merge into the sketch
of the whole set of shingles; two sketches estimate resemblance and containment, one alone the number of distinct
shingles. Below K distinct shingles all figures are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideglass.llm.common import ascii_lower, key_filter, maybe_in, text_of, written

K = 128
WORDS = 5
_BITS = 48
#: Coarse ranges of ids, and documents to a fine one.
_COARSE, _FINE_ROWS = 64, 1024
_LEAST = -(1 << 63)


def sketch(text: Column, k: int = K, words: int = WORDS) -> Column:
    """The sketch of a text: ascending hashes. A text of fewer words is one shingle; one without words has no hash.

    Words lie between ASCII white space; A-Z are lower-cased. Each array is bound once, as the argument of a lambda.
    """
    clean = F.btrim(ascii_lower(text), F.lit(" \t\n\x0b\x0c\r"))
    hashed = F.transform(F.split(clean, "[\\x20\\x09-\\x0D]+"), lambda w: F.xxhash64(w))

    def shingles(h: Column) -> Column:
        n = F.greatest(F.size(h) - (words - 1), F.lit(1))
        one = lambda i: F.shiftrightunsigned(F.xxhash64(*(F.get(h, i + j) for j in range(words))), 64 - _BITS)
        return F.transform(F.sequence(F.lit(0), n - 1), one)

    least = lambda h: F.slice(F.array_sort(F.array_distinct(shingles(h))), 1, k)
    return F.when(clean == "", F.array().cast("array<bigint>")).otherwise(F.get(F.transform(F.array(hashed), least), F.lit(0)))


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of all shingles of both."""
    return F.slice(F.array_sort(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of either that are in both; 1 for two texts without words."""
    of = lambda u: F.size(F.filter(F.array_intersect(a, b), lambda x: x <= F.element_at(u, -1))) / F.size(u)
    united = merge(a, b, k)
    share = F.get(F.transform(F.array(united), lambda u: F.when(F.size(u) == 0, F.lit(1.0)).otherwise(of(u))), F.lit(0))
    return share.cast("double")


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles."""
    size = F.size(a)
    return F.when(size < k, size.cast("double")).otherwise((k - 1) * float(1 << _BITS) / F.element_at(a, -1))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that are in b."""
    both, na, nb = resemblance(a, b, k), distinct_shingles(a, k), distinct_shingles(b, k)
    return F.when(na == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), both * (na + nb) / ((1 + both) * na)))


def fingerprint(a: Column) -> Column:
    """A sketch as text: its hashes, six bytes each, in base 64."""
    return F.base64(F.unhex(F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), _BITS // 4, "0")), "")))


def with_next(rows: DataFrame) -> DataFrame:
    """rows (doc_id, text) with next_text: the text of the next row in descending doc_id, behind the last the first.

    Ids are dealt to ranges: coarse ones between quantiles, fine ones even parts of those. The order within a fine range
    is a window's; behind its last row stands the first row of the next fine range that has any, found from one id a
    range. Null ids come last; rows of one id are ordered by text.
    """
    spark = rows.sparkSession
    rows = rows.withColumn("key", F.coalesce("doc_id", F.lit(_LEAST)))
    stats = rows.agg(F.count("*").alias("n"), F.percentile_approx("key", [i / _COARSE for i in range(_COARSE + 1)], 10_000).alias("q")).first()
    bounds = sorted(set(stats["q"] or [0]))
    parts = max(1, stats["n"] // (_FINE_ROWS * _COARSE))
    lows, spans = F.array(*map(F.lit, bounds)), F.array(*(F.lit(float(b) - float(a) + 1) for a, b in zip(bounds, bounds[1:] + [bounds[-1]], strict=True)))
    coarse = F.greatest(F.size(F.filter(lows, lambda b: b <= F.col("key"))) - 1, F.lit(0))
    share = (F.col("key").cast("double") - F.get(lows, F.col("coarse")).cast("double")) / F.get(spans, F.col("coarse"))
    fine = F.least(F.greatest(F.floor(share * parts), F.lit(0)), F.lit(parts - 1)).cast("int")
    placed = lambda df: df.withColumn("coarse", coarse).withColumn("fine", fine)
    heads = written(placed(rows.select("key")).groupBy("coarse", "fine").agg(F.max("key").alias("head")), "heads")
    firsts = {r["coarse"]: r["head"] for r in heads.groupBy("coarse").agg(F.max("head").alias("head")).collect()}  # _COARSE + 1 rows at most
    down = sorted(firsts, reverse=True)
    after = spark.createDataFrame([(a, firsts[b]) for a, b in zip(down, down[1:] + down[:1], strict=True)], "coarse int, behind long")
    order = Window.partitionBy("coarse").orderBy(F.col("fine").desc())
    follow = heads.join(F.broadcast(after), "coarse").select("coarse", "fine", F.coalesce(F.lead("head").over(order), "behind").alias("next_key"))
    hashed = F.xxhash64("key").alias("hashed")
    some = maybe_in(rows.select("key", "text", hashed), "hashed", key_filter(heads.select(F.xxhash64("head").alias("hashed")), "hashed"))
    # an inner join with distinct keys stays above the filter's; a semi join would be pushed below it
    texts = some.join(heads.select(F.col("head").alias("key")).distinct(), "key").groupBy("key").agg(F.min("text").alias("head_text"))
    borders = written(follow.join(texts.withColumnRenamed("key", "next_key"), "next_key").select("coarse", "fine", "head_text"), "borders")
    within = Window.partitionBy("coarse", "fine").orderBy(F.col("key").desc(), "text")
    led = placed(rows).withColumn("led", F.lead("text").over(within))
    return led.join(borders, ["coarse", "fine"]).select("doc_id", "text", F.coalesce("led", "head_text").alias("next_text"))


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, words: int = WORDS) -> DataFrame:
    """For each row of docs: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text is the text with its last floor(n_chars / 2) code points replaced by the first as many (or all) of
    the next document's, by descending doc_id, after the last the first. near_edited and near_next are the estimated
    resemblance of the text's fingerprint to the edited text's and to the next document's. A null text counts as empty;
    of texts without words the fingerprint is empty, and two such resemble each other fully. A single document is its
    own next. An empty table gives an empty result. Other columns are not read.
    """
    rows = with_next(docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(docs, text_col).alias("text")))
    cut = rows.withColumn("n_chars", F.char_length("text").cast("long"))
    edited = F.concat(F.expr("substring(text, 1, cast(n_chars - n_chars div 2 as int))"), F.expr("substring(next_text, 1, cast(n_chars div 2 as int))"))
    made = cut.withColumn("edited", edited).select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        sketch(F.col("text"), k, words).alias("s"), sketch(F.col("edited"), k, words).alias("e"), sketch(F.col("next_text"), k, words).alias("n"),
    )
    return made.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("s")).alias("fingerprint"), fingerprint(F.col("e")).alias("edited_fingerprint"),
        resemblance(F.col("s"), F.col("e"), k).alias("near_edited"), resemblance(F.col("s"), F.col("n"), k).alias("near_next"),
    )
