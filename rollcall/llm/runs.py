"""Periodic runs of words: maximal pairs of a text's repeats, from the tree of its LCP intervals."""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rollcall.llm.common import texts

#: a run has so many words, and two periods
LEAST = 12
#: the two ends of a pair share at least half of the shortest run
SHARED = LEAST // 2
#: characters of text in a group of results
GROUP_BYTES = 4_000_000


def _pair_ranks(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Dense ranks of pairs of ranks, in order."""
    return np.unique(left * (np.int64(right.max(initial=0)) + 1) + right, return_inverse=True)[1]


def suffix_order(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where suffixes begin whose first SHARED words occur twice, in the order of the suffixes, and the
    number of first words that each shares with the one before it (0 where another group begins).

    Ranks by the first k words double k until no two suffixes are equal.  A shorter suffix comes before those that it begins.
    """
    n = len(codes)
    # ranks by the first 2, 4 and then 6 = 4 + 2 words; behind the end stands a word before all others
    ended = np.concatenate([codes + 1, np.zeros(SHARED - 1, np.int64)])
    two = _pair_ranks(ended[:-1], ended[1:])
    four = _pair_ranks(two[:-2], two[2:])
    rank, k = _pair_ranks(four[:n], two[4:]) + 1, SHARED
    chosen = np.flatnonzero(np.bincount(rank)[rank] > 1)
    if not len(chosen):
        return chosen, chosen
    while rank.max() < n:
        later = np.concatenate([rank[k:], np.zeros(min(k, n), np.int64)])
        rank, k = _pair_ranks(rank, later) + 1, 2 * k
    order = chosen[np.argsort(rank[chosen], kind="stable")]
    # common beginnings in the order of the text: each has at most one word less than the one before
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    words, up, at = codes.tolist(), before.tolist(), [0] * n
    for i in chosen.tolist():
        j = up[i]
        # only where the next words are still SHARED or more, both of them are in the order
        h = at[i - 1] - 1 if i and at[i - 1] > SHARED else 0
        if j >= 0:
            end = n - max(i, j)
            while h < end and words[i + h] == words[j + h]:
                h += 1
            at[i] = h if h >= SHARED else 0
    return order, np.array(at, np.int64)[order]


class Occurrences:
    """Where the words of an LCP interval occur, listed by the word to their left.

    Positions are sorted and cut into stretches with one and the same left word (``cuts`` holds where they begin).
    Occurrences that overlap the one before them all have the same word to their left, so within a distance
    no longer than what is shared there are only a few stretches, and those of a position's own left word are skipped whole.
    """

    __slots__ = ("at", "cuts")

    def __init__(self, position: int):
        self.at, self.cuts = [position], [position]

    def add(self, p: int, left: list[int]) -> None:
        i = bisect_left(self.at, p)
        if i < len(self.at):
            b = self.at[i]
            was = i == 0 or left[self.at[i - 1]] != left[b]
            now = left[b] != left[p]
            if was and not now:
                del self.cuts[bisect_left(self.cuts, b)]
            elif now and not was:
                insort(self.cuts, b)
        if i == 0 or left[self.at[i - 1]] != left[p]:
            insort(self.cuts, p)
        self.at.insert(i, p)

    def others(self, p: int, shared: int, left: list[int]) -> Iterator[int]:
        """Positions at most ``shared`` away whose left word is another one."""
        i, high = bisect_left(self.at, p - shared), p + shared
        while i < len(self.at) and self.at[i] <= high:
            c = bisect_right(self.cuts, self.at[i])
            end = bisect_left(self.at, self.cuts[c]) if c < len(self.cuts) else len(self.at)
            if left[self.at[i]] != left[p]:
                yield from self.at[i:min(end, bisect_right(self.at, high))]
            i = end


def find_runs(codes: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` of a text's words, given as numbers, by start and period.

    A run of ``length`` words with period q is the same as a maximal pair: the words from its start on and those
    from q further on share length - q words, at least q, and neither the words before nor those after
    are equal.  The tree of LCP intervals is gone through from the leaves up: where children of an interval
    join, their occurrences, which differ in the next word, are paired if they differ in the left word
    too and are no further apart than what they share.  Of pairs for one stretch of words the closest
    gives its period; the others are multiples of it.
    """
    if len(codes) < LEAST:
        return []
    order, shared = suffix_order(codes)
    if not len(order):
        return []
    left = [-1, *codes[:-1].tolist()]
    found: dict[tuple[int, int], int] = {}

    def join(into: Occurrences, child: Occurrences, size: int) -> Occurrences:
        small, large = (into, child) if len(into.at) < len(child.at) else (child, into)
        for p in small.at:
            for other in large.others(p, size, left):
                q = abs(other - p)
                if size + q >= LEAST:
                    stretch = (min(p, other), size + q)
                    found[stretch] = min(q, found.get(stretch, q))
        for p in small.at:
            large.add(p, left)
        return large

    stack: list[tuple[int, Occurrences]] = []
    current = Occurrences(int(order[0]))
    for position, size in zip([*order[1:].tolist(), -1], [*shared[1:].tolist(), 0]):
        while stack and stack[-1][0] > size:
            above, node = stack.pop()
            current = join(node, current, above)
        if size and stack and stack[-1][0] == size:
            stack[-1] = (size, join(stack[-1][1], current, size))
        elif size:
            stack.append((size, current))
        current = Occurrences(position)
    return sorted(((start, length, q) for (start, length), q in found.items()), key=lambda r: (r[0], r[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay when every run is cut to its first period."""
    edges = np.zeros(n + 1, np.int64)
    for start, length, q in runs:
        edges[start + q] += 1
        edges[start + length] -= 1
    return np.cumsum(edges[:n]) == 0


def numbered(words: list[bytes]) -> np.ndarray:
    names: dict[bytes, int] = {}
    return np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, len(words))


def repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words with a tail that repeats, for one document in ten by the crc32 of its id; not without an id."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    tail = words[a:a + p]
    return words[:a] + (tail * ((n - a) // len(tail) + 1))[:n - a]


def periodic_runs(docs: DataFrame, planted: bool = False) -> DataFrame:
    """The periodic runs of every whole text and the text without their repeats.

    Words are runs of characters other than white space (9-13 and 32).  A run is a stretch of consecutive words with
    smallest period q, at least 12 words and two periods long, that no neighbouring word extends.  Returns, for
    each row, ``doc_id``, ``runs`` (array of start, length, period, by start and period) and ``collapsed``: the words,
    joined by one space, without those that any run contains after its first period.  ``planted`` first
    makes the tails of one document in ten repeat (``repeated_tail``; a null id never).

    A null or empty text, or one without words, has no runs and collapses to an empty text.  Rows are
    independent of each other: repeated ones have equal results, and an executor lost costs its rows.  Other
    columns go.  A text is worked on by one task; time grows with its words and their logarithm.
    """
    rows = texts(docs, "doc_id")
    kind = rows.schema["doc_id"].dataType.simpleString()
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, made, size = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                words = text.as_py().split()
                words = repeated_tail(doc_id, words) if planted else words
                runs = find_runs(numbered(words))
                if runs:
                    words = [w for w, keep in zip(words, kept_words(len(words), runs).tolist()) if keep]
                collapsed = b" ".join(words)
                ids.append(doc_id)
                made.append(([{"start": s, "length": n, "period": q} for s, n, q in runs], collapsed))
                size += len(collapsed)
                if size > GROUP_BYTES:
                    yield results(batch, ids, made)
                    ids, made, size = [], [], 0
            if ids:
                yield results(batch, ids, made)

    def results(batch: pa.RecordBatch, ids: list, made: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, batch.schema.field(0).type), pa.array([m[0] for m in made], pa.list_(run)), pa.array([m[1] for m in made], pa.binary()).cast(pa.string())],
            ["doc_id", "runs", "collapsed"])

    return rows.mapInArrow(work, f"doc_id {kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def op13_periodic_runs(docs: DataFrame) -> DataFrame:
    """Number of runs, the longest one (ties: smallest start, then period) and digests of runs and collapsed text."""
    found = periodic_runs(docs, planted=True)
    longest = F.get(F.array_sort(F.transform("runs", lambda r: F.struct(-r["length"], r["start"], r["period"]))), 0)
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    top = found.select("*", longest.alias("top")).select("*", (-F.col("top.col1")).alias("length"), F.col("top.start"), F.col("top.period"))
    return top.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "start", "length", "period",
        F.floor(1000 * F.col("length") / F.col("period")).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


#: repeats are pairs of equal six words; DuckDB has no crc32, so a table made by its rule is folded over the digits
SQL = r"""
WITH RECURSIVE bits AS (
  SELECT range AS b, range AS c, 0 AS k FROM range(256)
  UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS MATERIALIZED (SELECT list(c ORDER BY b) AS t FROM bits WHERE k = 8),
read AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
  coalesce(xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
    lambda h, x: xor(t[xor(h, x) % 256 + 1], h >> 8), 4294967295), 4294967295), 1) AS h FROM documents, crc),
tail AS (SELECT *, len(w) AS n, (h // 10) % greatest(len(w), 1) AS a FROM read),
period AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM tail),
docs AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, n, CASE WHEN h % 10 = 0 THEN list_transform(range(n), lambda i: w[CASE WHEN i >= a THEN a + (i - a) % p ELSE i END + 1]) ELSE w END AS w FROM period),
six AS (SELECT row, unnest(range(1, n - 4)) AS i, unnest(list_transform(range(1, n - 4), lambda i: array_to_string(w[i:i + 5], ' '))) AS g FROM docs),
pairs AS (SELECT a.row, a.i, b.i - a.i AS q FROM six a JOIN six b ON a.row = b.row AND a.g = b.g AND a.i < b.i),
islands AS (SELECT row, q, i, i - row_number() OVER (PARTITION BY row, q ORDER BY i) AS island FROM pairs),
matched AS (SELECT row, q, min(i) - 1 AS start, count(*) + 5 AS m FROM islands GROUP BY row, q, island),
runs AS MATERIALIZED (SELECT row, start, m + q AS length, min(q) AS period FROM matched WHERE m >= q AND m + q >= 12 GROUP BY row, start, m + q),
per AS (SELECT row, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed,
  first({'s': start, 'l': length, 'p': period} ORDER BY length DESC, start, period) AS top FROM runs GROUP BY row),
spread AS (SELECT row, unnest(range(n)) AS i, unnest(w) AS word FROM docs),
dropped AS (SELECT DISTINCT row, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT row, string_agg(word, ' ' ORDER BY i) AS text FROM spread ANTI JOIN dropped USING (row, i) GROUP BY row)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, top.s AS start, top.l AS length, top.p AS period, CAST(floor(1000 * top.l / top.p) AS BIGINT) AS exponent_milli,
  sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM docs LEFT JOIN per USING (row) LEFT JOIN kept USING (row)"""
