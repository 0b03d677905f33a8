"""HyperMinHash near duplicates, spelling variants and periodic runs against brute force and SQL."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from rollcall.llm import hyperminhash, queries, runs, spelling
from rollcall.llm.shingles import shingle_set
from tests.compare import check, connect
from tests.llm.test_operators import documents, key, odd_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def odd(spark):
    return documents(spark, odd_rows())


@pytest.fixture(scope="module")
def none(spark):
    return documents(spark, [])


@pytest.mark.parametrize("name", ["op12_spelling_variants", "op13_periodic_runs"])
def test_query_equals_sql(spark, name):
    state, text = check(spark, connect(SF_DIR), name, queries.QUERIES[name], queries.SQL[name], SF_DIR)
    assert state == "ok", text


# --- near duplicates ------------------------------------------------------------------


def linked_components(rows, words, percent):
    """Union-find over all pairs of texts; rows are documents."""
    sets = []
    for _, text, _ in rows:
        own = WORD.findall((text or "").translate(str.maketrans(spelling.UPPER, spelling.LOWER)))
        n = min(words, len(own))
        sets.append({tuple(own[i:i + n]) for i in range(len(own) - n + 1)} if own else set())
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                up[max(top(i), top(j))] = min(top(i), top(j))
    low = {}
    for i, (doc_id, _, _) in enumerate(rows):
        if doc_id is not None:
            low[top(i)] = min(low.get(top(i), doc_id), doc_id)
    return [(doc_id, len(sets[i]), None if doc_id is None else low[top(i)], None if doc_id is None else low[top(i)] == doc_id)
            for i, (doc_id, _, _) in enumerate(rows)]


def near_copies(seed=1, groups=25):
    """Groups of copies with few or many words changed, chains whose ends are far apart, short texts."""
    rng = random.Random(seed)
    rows, doc_id = [], 1000
    for g in range(groups):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([1, 2, 4, 6, 11, 30, 90, 300, 2200]))]
        for k in range(rng.choice([1, 3, 8])):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, len(text) // 25, len(text) // 8])):
                text[rng.randrange(len(text))] = f"x{rng.randrange(10**6)}"
            doc_id -= 1
            rows.append((None if rng.random() < 0.03 else doc_id, " ".join(text) if k else " ".join(text).upper(), "s"))
        chain = list(base)
        for _ in range(6):
            chain = list(chain)
            for _ in range(max(1, len(chain) // 18)):
                chain[rng.randrange(len(chain))] = f"y{rng.randrange(10**6)}"
            doc_id -= 1
            rows.append((doc_id, " ".join(chain), "s"))
    return rows


def found_components(docs, words=2, percent=80):
    return key([(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in hyperminhash.near_duplicates(docs, words, percent).collect()])


@pytest.mark.parametrize("words, percent", [(2, 80), (5, 80)])
def test_near_duplicates_equal_brute_force(spark, words, percent):
    rows = near_copies(words)
    assert found_components(documents(spark, rows), words, percent) == key(linked_components(rows, words, percent))


def test_near_duplicates_of_a_large_group(spark):
    """Copies of one text that differ in many ways, some near enough to each other only: several blocks."""
    rng = random.Random(9)
    base = [f"w{rng.randrange(300)}" for _ in range(60)]
    rows = []
    for i in range(420):
        text = list(base)
        for _ in range(rng.choice([1, 2, 3, 4, 5, 8])):
            text[rng.randrange(60)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(text), "s"))
    assert found_components(documents(spark, rows)) == key(linked_components(rows, 2, 80))


def test_near_duplicates_of_odd_rows(odd, none):
    assert found_components(none) == []
    assert found_components(odd) == key(linked_components(odd_rows(), 2, 80))


def test_a_row_without_id_ties_others(spark):
    base = [f"w{i}" for i in range(100)]
    a, n, b = base, base[:94] + ["p"] * 6, base[:88] + ["p"] * 12
    b = base[:88] + [f"q{i}" for i in range(6)] + base[94:94] + ["p"] * 6
    rows = [(1, " ".join(a), "s"), (None, " ".join(n), "s"), (2, " ".join(b), "s")]
    assert found_components(documents(spark, rows)) == key(linked_components(rows, 2, 80))


def test_estimates_are_corrected():
    """Sketches of sets of every size estimate their similarity; unrelated ones are estimated at zero."""
    rng = np.random.default_rng(0)
    for n in (3, 17, 130, 900, 5000):
        k = hyperminhash.bucket_count(n)
        for share in (0.0, 0.5, 0.9):
            common = int(n * share)
            found = []
            for _ in range(20):
                pool = rng.integers(0, 2**63, 2 * n).astype(np.uint64)
                a, b = np.unique(pool[:n]), np.unique(np.concatenate([pool[:common], pool[n:2 * n - common]]))
                found.append(hyperminhash.estimate(hyperminhash.sketch(a, k), hyperminhash.sketch(b, k), np.float64(n), np.float64(n), np.float64(k)))
            assert abs(np.mean(found) - common / (2 * n - common)) < 0.02


def test_sketches_on_both_sides_of_a_step():
    """Two linked sets always have sketches with the same number of buckets."""
    for n in range(1, 3000):
        for m in {n, -(-8 * n // 10)}:
            mine = {hyperminhash.bucket_count(n)} | ({hyperminhash.bucket_count(n) // 2} if hyperminhash.also_below(n, 80) else set())
            assert hyperminhash.bucket_count(m) in mine, (n, m)


# --- spelling -------------------------------------------------------------------------


def edits(word, letters):
    cuts = {word[:i] + word[i + 1:] for i in range(len(word))}
    swaps = {word[:i] + c + word[i + 1:] for i in range(len(word)) for c in letters if c != word[i]}
    more = {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
    return cuts | swaps | more


def brute_forms(counts):
    letters = {c for w in counts for c in w}
    out = {}
    for word, n in counts.items():
        near = [w for w in edits(word, letters) if w in counts]
        best = min(near, key=lambda w: (-counts[w], w), default=None)
        form = best if best is not None and counts[best] >= 2 * n else None
        out[word] = (n, len(near), form, counts[form] if form else None)
    rows = []
    for word, (n, near, form, form_n) in out.items():
        root = word
        while out[root][2]:
            root = out[root][2]
        rows.append((word, n, near, form, form_n, root))
    return rows


def form_rows(df):
    return key([(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()])


def test_forms_equal_brute_force(spark):
    rng = random.Random(4)
    counts = {"".join(rng.choice("abÿ") for _ in range(rng.randrange(1, 7))): rng.choice([1, 2, 3, 4, 8, 16, 16, 40]) for _ in range(600)}
    counts |= {"aaaaab": 2, "aaaab": 4, "aaab": 8, "x" * 200: 5, "x" * 199: 11, "x" * 99 + "y" + "x" * 100: 2}
    words = spark.createDataFrame([(w, n, 1, "k") for w, n in counts.items()] + [(None, 3, 1, "k"), ("nocount", None, 1, "k")], "word string, n long, rank int, key string")
    assert form_rows(spelling.spelling_forms(words)) == key(brute_forms(counts))


def test_forms_of_no_words(spark, none):
    assert spelling.spelling_forms(spark.createDataFrame([], "word string, n long")).count() == 0
    assert spelling.op12_spelling_variants(none).count() == 0


def brute_words(rows):
    counts = Counter()
    for doc_id, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans(spelling.UPPER, spelling.LOWER))
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def test_words_of_documents(spark, odd):
    rng = random.Random(2)
    vocabulary = ["Straße", "houses", "HOUSES", "Àcute", "àcute", "mouse's", "naïve-looking", "abcde", "abcd", "日本words"]
    rows = odd_rows() + [(i if i % 50 else None, " ".join(rng.choices(vocabulary, k=200)), "s") for i in range(300)]
    assert form_rows(spelling.op12_spelling_variants(documents(spark, rows))) == key(brute_forms(brute_words(rows)))


# --- runs -----------------------------------------------------------------------------


def smallest_period(words):
    border = [0] * len(words)
    k = 0
    for i in range(1, len(words)):
        while k and words[i] != words[k]:
            k = border[k - 1]
        k += words[i] == words[k]
        border[i] = k
    return len(words) - border[-1]


def brute_runs(words):
    out = set()
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if i > start and length >= max(12, 2 * q) and smallest_period(words[start:start + length]) == q:
                out.add((start, length, q))
            i += i == start
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    rng = random.Random(5)
    for _ in range(600):
        letters = rng.choice([1, 2, 2, 3, 5])
        words = [rng.randrange(letters) for _ in range(rng.randrange(0, 110))]
        if rng.random() < 0.6 and len(words) > 20:
            a, p = rng.randrange(len(words) - 12), rng.randrange(1, 12)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, len(words))]
        assert runs.find_runs(np.array(words, np.int64)) == brute_runs(words), words


def test_runs_of_long_texts():
    """Texts in which all words, or words at Fibonacci distances, repeat: work grows little faster than the words."""
    assert runs.find_runs(np.zeros(200_000, np.int64)) == [(0, 200_000, 1)]
    blocks = np.concatenate([np.append(np.zeros(40, np.int64), i + 1) for i in range(2000)])
    assert len(runs.find_runs(blocks)) == 2000
    a, b = [0], [0, 1]
    while len(b) < 30_000:
        a, b = b, b + a
    assert len(runs.find_runs(np.array(b, np.int64))) > 1000


def brute_row(doc_id, text):
    words = WORD.findall(text or "")
    if doc_id is not None and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
    found = brute_runs(words) if len(words) < 1000 else None
    if found is None:
        return None
    top = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    digest = lambda t: hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest()
    return (doc_id, len(found), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
            digest("".join(f"{s},{n},{q}\n" for s, n, q in found)), digest(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def test_run_digests_equal_brute_force(spark, odd, none):
    rng = random.Random(7)
    rows = odd_rows() + [(i, " \n".join(rng.choices(["a", "b", "ü"], k=rng.randrange(80))), "s") for i in range(120)]
    assert runs.op13_periodic_runs(none).count() == 0
    got = runs.op13_periodic_runs(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    columns = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    expected = [r for r in (brute_row(i, t) for i, t, _ in rows) if r]
    assert set(expected) <= {tuple(r[c] for c in columns) for r in got}
    long = next(r for r in got if r.doc_id == 5)
    # w0 .. w976 over and over, unless the id's own tail repeats first
    assert long.n_runs >= 1 and long.length >= 20_000
