"""Document fingerprints: threshold-scaled sketches of word shingles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rollcall.llm.common import in_ranges, texts, words

SHINGLE = 5
#: one shingle hash in so many is retained
SCALE = 4
UNSIGNED = 2**64


def shingle_hashes(text: Column, n: int = SHINGLE) -> Column:
    """A 64-bit hash for each run of ``n`` words; a shorter text is one run; none without words."""
    # binding a value once: an array of one element, transformed, is worked out a single time
    once = lambda value, use: F.get(F.transform(F.array(value), use), 0)

    def runs(own: Column) -> Column:
        long = F.transform(F.sequence(F.lit(0), F.size(own) - n), lambda i: F.xxhash64(*[F.get(own, i + k) for k in range(n)]))
        return F.when(F.size(own) == 0, own).when(F.size(own) < n, F.array(F.xxhash64(own))).otherwise(long)

    return once(F.transform(words(text), lambda w: F.xxhash64(w)), runs)


def sketch(text: Column, n: int = SHINGLE, scale: int = SCALE) -> Column:
    """The text's distinct shingle hashes below 1 / ``scale`` of their range, sorted.

    Which hashes are retained depends on the hash alone, so the sketch of a union is the union of
    the sketches, and the share of one sketch found in another estimates containment however
    unequal the texts are.  Where no hash is below the threshold, the lowest one stands in, so
    that a text with words never has an empty sketch; in a union it is one hash more.
    """
    limit = -(2**63) + UNSIGNED // scale
    once = lambda value, use: F.get(F.transform(F.array(value), use), 0)

    def retain(hashes: Column) -> Column:
        below = F.filter(hashes, lambda h: h < F.lit(limit))
        return F.when(F.size(hashes) == 0, hashes).otherwise(
            once(below, lambda kept: F.when(F.size(kept) > 0, F.array_sort(F.array_distinct(kept))).otherwise(F.array(F.array_min(hashes)))))

    return once(shingle_hashes(text, n), retain)


def printed(hashes: Column) -> Column:
    """A sketch as text: its hashes in hexadecimal, joined by dots; empty for a text without words."""
    return F.array_join(F.transform(hashes, lambda h: F.lower(F.hex(h))), ".")


def shared(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def likeness(a: Column, b: Column, common: Column) -> Column:
    """Estimated Jaccard similarity; two texts without words are alike."""
    union = F.size(a) + F.size(b) - common
    return F.when(union == 0, 1.0).otherwise(common / union).cast("double")


def containment(part: Column, common: Column) -> Column:
    """Estimated share of the first text's shingles that the second one has; 1 for a text without words."""
    return F.when(F.size(part) == 0, 1.0).otherwise(common / F.size(part)).cast("double")


def merge(sketches: DataFrame, group: str, column: str = "sketch") -> DataFrame:
    """One sketch for all documents of a group: the union of theirs, a row for each (group, hash)."""
    return sketches.select(group, F.explode(column).alias("hash")).distinct()


def fingerprints(docs: DataFrame, *keep: str, n: int = SHINGLE, scale: int = SCALE) -> DataFrame:
    """``sketch array<long>`` and ``fingerprint string`` of every whole text, beside the columns in ``keep``.

    Equal texts have equal fingerprints.  A null or empty text, or one without words, has an
    empty one.  Repeated rows all stay; other columns go.
    """
    rows = texts(docs, *keep).select(*keep, sketch(F.col("text"), n, scale).alias("sketch"))
    return rows.select(*keep, "sketch", printed(F.col("sketch")).alias("fingerprint"))


def neighbours(docs: DataFrame) -> DataFrame:
    """``doc_id, digest, before``: for each document the one that it follows, by descending doc_id.

    Documents of equal id follow each other by a digest of their text; rows equal in both are one document.  The order is cut into
    ranges; inside, a window looks one row back, and the first row of a range follows the last
    one of the range before it.  The first of all follows the last of all.  Only ids, digests and
    lengths take part.
    """
    rows = texts(docs, "doc_id").select("doc_id", F.xxhash64("text").alias("digest"), F.length("text").cast("long").alias("n_chars")).distinct()
    order = [F.col("doc_id").desc_nulls_last(), F.col("digest")]
    ranged = in_ranges(rows, order, "order")
    inside = Window.partitionBy("__range").orderBy(*order)
    own = F.struct("doc_id", "digest", "n_chars")
    linked = ranged.withColumn("before", F.lag(own).over(inside))
    last = ranged.withColumn("at", F.row_number().over(inside)).groupBy("__range").agg(F.max_by(own, "at").alias("last"))
    # a row for each range
    ends = last.select("__range", F.coalesce(F.lag("last").over(Window.orderBy("__range")),
                                             F.first("last").over(Window.orderBy(F.desc("__range")))).alias("ends"))
    return linked.join(ends, "__range").select("doc_id", "digest", F.coalesce("before", "ends").alias("before"))


def edited_likeness(docs: DataFrame, n: int = SHINGLE, scale: int = SCALE) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text has its last third of code points (floor) replaced by as many first ones (or
    all) of the next document by descending doc_id; the last document is followed by the first.
    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, in_edited, in_next``: ``near_*`` estimate Jaccard similarity, ``in_*`` containment.

    A null text is an empty one.  Rows with equal id and text are one document in the order; each of
    them is returned.  A single document is its own next one.  Null ids come last.
    """
    # plain keys: joins and grouping on a null-safe comparison would deal the rows out differently, once more each
    name = lambda c: F.coalesce(F.concat(F.lit("+"), F.col(c).cast("string")), F.lit("-"))
    links = neighbours(docs)
    # both joins read these three columns and no other, so the text is dealt out once for both
    rows = texts(docs, "doc_id").select(name("doc_id").alias("name"), F.xxhash64("text").alias("digest"), "text")
    # the text of each document, sent to the one that it follows: only the part that this one takes, and its sketch
    asked = links.select(name("doc_id").alias("name"), "digest", name("before.doc_id").alias("to_name"), F.col("before.digest").alias("to_digest"),
                         F.col("before.doc_id").alias("to_id"), F.floor(F.col("before.n_chars") / 3).cast("int").alias("take"))
    sent = rows.join(asked, ["name", "digest"]).select(
        F.col("to_name").alias("name"), F.col("to_digest").alias("digest"), "to_id",
        F.substring("text", F.lit(1), F.col("take")).alias("taken"), sketch(F.col("text"), n, scale).alias("next"))
    # repeated rows send the same; every document is sent something, and its id with it
    sent = sent.groupBy("name", "digest").agg(*[F.first(c).alias(c) for c in ("to_id", "taken", "next")])
    joined = rows.join(sent, ["name", "digest"])
    size = F.length("text")
    edited = F.concat(F.substring("text", F.lit(1), size - F.floor(size / 3).cast("int")), F.coalesce("taken", F.lit("")))
    made = joined.select(F.col("to_id").alias("doc_id"), size.cast("long").alias("n_chars"), edited.alias("edited"), sketch(F.col("text"), n, scale).alias("own"), "next")
    made = made.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "own", "next", sketch(F.col("edited"), n, scale).alias("changed"))
    made = made.select("*", shared(F.col("own"), F.col("changed")).alias("c1"), shared(F.col("own"), F.col("next")).alias("c2"))
    own, changed, following = F.col("own"), F.col("changed"), F.col("next")
    return made.select(
        "doc_id", "n_chars", "edited_sha256", printed(own).alias("fingerprint"), printed(changed).alias("edited_fingerprint"),
        likeness(own, changed, F.col("c1")).alias("near_edited"), likeness(own, following, F.col("c2")).alias("near_next"),
        containment(own, F.col("c1")).alias("in_edited"), containment(own, F.col("c2")).alias("in_next"))


def op2_fingerprints(docs: DataFrame) -> DataFrame:
    return edited_likeness(docs)
