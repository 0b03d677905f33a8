"""Spelling variants: words one edit apart meet as prefix ranges of the sorted rotations of marked words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rollcall.llm.common import texts
from rollcall.session import stored

#: a word: Latin letters, the accented ones too
LETTERS = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: stands after a word's last letter; no letter itself
MARK = "$"
#: a prefix of more characters is named by its beginning and its digest
LONG = 64
LEAST_LENGTH, LEAST_COUNT, RATIO = 5, 3, 2
#: one run in so many loses a letter in the query
FAULTS = 97


def letter_runs(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns in ``keep`` and ``run``: every run of letters of every whole text, A-Z lower-cased."""
    text = F.translate(F.col("text"), UPPER, LOWER)
    return texts(docs, *keep).select(*keep, F.explode(F.regexp_extract_all(text, F.lit(LETTERS), F.lit(0))).alias("run"))


def counted_words(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n``: the distinct words of enough letters that occur often enough; counted before they are shuffled."""
    long = words.where(F.length("word") >= least_length)
    return long.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def _named(prefix: Column) -> Column:
    return F.when(F.length(prefix) <= LONG, prefix).otherwise(F.concat(F.left(prefix, F.lit(LONG // 2)), F.sha2(prefix, 256)))


def rotations(words: DataFrame) -> DataFrame:
    """All rotations of the marked words, whole and as prefixes that skip the last letter, sorted.

    ``key, rank, word, skips, first``.  The rotation of a word that begins behind its letter i ends with
    that letter: without it, it is the prefix that words share which have another letter there, and it is
    the whole rotation of the word that lacks the letter.  So replacements and indels both meet under
    one prefix.  ``first`` marks the first letter of a row of equal ones, as leaving out any of
    them gives the same word.  ``rank`` is the negative count: often seen words come first.
    """
    turned = words.select("word", (-F.col("n")).alias("rank"), F.explode(F.sequence(F.lit(0), F.length("word"))).alias("i"))
    left = lambda size: F.substring("word", F.lit(1), size)
    right = F.substring("word", F.col("i") + 1, F.length("word"))
    letter = lambda at: F.substring("word", at, F.lit(1))
    whole = F.struct(_named(F.concat(right, F.lit(MARK), left(F.col("i")))).alias("key"), F.lit(False).alias("skips"), F.lit(False).alias("first"))
    prefix = F.struct(_named(F.concat(right, F.lit(MARK), left(F.col("i") - 1))).alias("key"), F.lit(True).alias("skips"),
                      ((F.col("i") == 1) | (letter(F.col("i")) != letter(F.col("i") - 1))).alias("first"))
    rows = turned.select("word", "rank", F.explode(F.when(F.col("i") == 0, F.array(whole)).otherwise(F.array(whole, prefix))).alias("r"))
    rows = rows.select("r.key", "rank", "word", "r.skips", "r.first")
    return rows.repartitionByRange("key").sortWithinPartitions("key", "rank", "word")


def neighbours(words: DataFrame) -> DataFrame:
    """``word, n_near, best``: how many words are one edit away, and the most frequent of them.

    One scan over the sorted rotations.  A group has at most as many members as there are
    letters, and one more; each member learns the group's numbers instead of its partners, so no pairs are
    written.  Two words meet in one group only.
    """
    group = Window.partitionBy("key").orderBy("rank", "word").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    own = F.struct("rank", "word")
    skips, first = F.col("skips"), F.col("first")
    seen = rotations(words).select(
        "word", skips, first, own.alias("own"), F.count(F.lit(1)).over(group).alias("size"),
        F.count(F.when(skips, 1)).over(group).alias("n_skips"), F.count(F.when(first, 1)).over(group).alias("n_first"),
        F.min(F.when(skips, own)).over(group).alias("top"), F.nth_value(F.when(skips, own), 2, ignoreNulls=True).over(group).alias("second"),
        F.min(F.when(first, own)).over(group).alias("top_first"), F.min(F.when(~skips, own)).over(group).alias("whole")).where("size > 1")
    shorter = F.when(first, F.col("whole"))
    other = F.when(F.col("own") == F.col("top"), F.col("second")).otherwise(F.col("top"))
    met = seen.select(
        "word", F.when(skips, F.col("n_skips") - 1 + shorter.isNotNull().cast("long")).otherwise(F.col("n_first")).alias("n_near"),
        F.when(skips, F.least(other, shorter)).otherwise(F.col("top_first")).alias("best"))
    return met.where("n_near > 0").groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """``word, root`` for the links ``word, form``: where following forms ends.

    Each round jumps twice as far, so chains, whose counts grow by a factor at each step, end in a handful of rounds.
    """
    now = links.select("word", F.col("form").alias("root"))
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = stored(now.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if not now.where("moved").take(1):
            return now.select("word", "root")
        now = now.select("word", "root")


def spelling_forms(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """The likely right form of every word: ``word, n, n_near, form, form_n, root``.

    ``words`` has distinct ``word`` and its count ``n``.  Two words are near if one inserted, deleted or
    replaced code point makes one of the other.  The form is the near word of the largest n, ties to
    the smallest in code-point order, if that n is at least ``ratio`` (more than 1) times the word's; else
    null.  ``root`` follows forms to the last.  A word without near ones has n_near 0.  Rows with a null
    word or n go; other columns go.  A word of many letters costs the square of its length, as it has as
    many rotations as letters.
    """
    words = stored(words.where("word IS NOT NULL AND n IS NOT NULL").select("word", "n"), "words")
    found = words.join(neighbours(words), "word", "left")
    best_n = -F.col("best.rank")
    chosen = best_n >= ratio * F.col("n")
    forms = stored(found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                F.when(chosen, F.col("best.word")).alias("form"), F.when(chosen, best_n).alias("form_n")), "forms")
    ends = roots(forms.where("form IS NOT NULL"))
    return forms.join(ends, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def faulty_words(docs: DataFrame) -> DataFrame:
    """``word``: every run of letters; one in FAULTS, by the crc32 of id and run, without one of its letters.

    A null id counts as empty text, a null text has no words.
    """
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    runs = letter_runs(docs, "doc_id").select("run", F.crc32(F.encode(named, "UTF-8")).alias("h"))
    cut = (F.col("h") % F.length("run")).cast("int")
    without = F.concat(F.substring("run", F.lit(1), cut), F.substring("run", cut + 2, F.length("run")))
    return runs.select(F.when(F.col("h") % FAULTS == 0, without).otherwise(F.col("run")).alias("word"))


def op12_spelling_variants(docs: DataFrame) -> DataFrame:
    """Forms of all words of at least five letters seen three times or more; repeated rows count each time, other columns go."""
    return spelling_forms(counted_words(faulty_words(docs))).select("word", "form", "root", "n", "n_near", "form_n")


#: DuckDB has no crc32: a table made by its rule (reflected polynomial EDB88320), folded over the bytes
SQL = """
WITH RECURSIVE bits AS (
  SELECT range AS b, range AS c, 0 AS k FROM range(256)
  UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS MATERIALIZED (SELECT list(c ORDER BY b) AS t FROM bits WHERE k = 8),
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{00C0}-\\x{00FF}]+')) AS run FROM documents),
per AS (SELECT run, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS named, count(*) AS k FROM runs GROUP BY ALL),
bytes AS (SELECT *, list_transform(regexp_extract_all(hex(encode(named)), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS data FROM per),
hashed AS (SELECT run, k, xor(list_reduce(data, lambda h, x: xor(t[xor(h, x) % 256 + 1], h >> 8), 4294967295), 4294967295) AS h FROM bytes, crc),
made AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM hashed),
words AS MATERIALIZED (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM made WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
cuts AS MATERIALIZED (SELECT DISTINCT word, n, p, substr(word, 1, p - 1) AS l, substr(word, p + 1) AS r FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM cuts a JOIN cuts b ON a.p = b.p AND a.l = b.l AND a.r = b.r AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON b.word = a.l || a.r
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON b.word = a.l || a.r),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY m DESC, other) AS other, max(m) AS m FROM near GROUP BY word),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * w.n THEN other END AS form, CASE WHEN m >= 2 * w.n THEN m END AS form_n FROM words w LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS at FROM forms UNION ALL SELECT walk.word, f.form FROM walk JOIN forms f ON f.word = walk.at WHERE f.form IS NOT NULL),
ends AS (SELECT walk.word, walk.at AS root FROM walk JOIN forms f ON f.word = walk.at WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)"""
