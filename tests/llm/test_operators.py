"""The text operators against brute force, on hand-made rows with nulls, ties, repeats, long texts and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.llm import common, fingerprints, jaccard, lines, lm, mixing, quality, tokens, toxicity, urls, warc
from rollcall.llm.shingles import shingle_set

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, score string, hash string, row string, label string"


def documents(spark, rows):
    """Rows (doc_id, text, source) as a table that has further columns named like those the operators make."""
    full = [(i, t, "en", s, None if t is None else len(t), "x", "y", "z", "r", "l") for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def odd_rows():
    long = " ".join(f"w{k % 977}" for k in range(30_000))
    return [(1, "one two three four five six", "a"), (1, "one two three four five six", "a"), (2, None, None), (3, "", "a"),
            (4, " \t\n ", "b"), (5, long, "b"), (None, "no id here", "c"), (7, "Ünïcode 日本語 text\u2581with marks  and  spaces \x00 end", "c"),
            (8, "a\nb\na\n\nb", None), (9, "x" * 50_000, "a"), (10, "tie tie tie tie tie tie tie tie tie tie tie tie", "b")]


def key(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def odd(spark):
    return documents(spark, odd_rows())


@pytest.fixture(scope="module")
def none(spark):
    return documents(spark, [])


def every(odd, none, run):
    """Runs on the odd rows and on an empty table."""
    assert run(none).count() == 0
    return run(odd).collect()


def test_tokens_equal_the_library(odd, none):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=tokens.model_path())
    found = every(odd, none, lambda d: tokens.encode_decode(d, tokens.model_path(), batch_chars=1000))
    expected = [(i, model.encode(t or ""), model.decode(model.encode(t or ""))) for i, t, _ in odd_rows()]
    assert key([(r.doc_id, r.ids, r.decoded) for r in found]) == key(expected)


def test_tokens_of_random_spacing():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=tokens.model_path())
    rng, table = random.Random(3), tokens.ChunkTable(tokens.model_path())
    made = ["".join(rng.choice(["a", "the", " ", "  ", "▁", "\n", "é", "\U0001F600", "x1", "\t"]) for _ in range(rng.randrange(30))) for _ in range(400)]
    ids, said = table.lookup(made)
    assert ids.to_pylist() == [model.encode(t) for t in made]
    assert said.to_pylist() == [model.decode(model.encode(t)) for t in made]


def test_a_full_chunk_table_starts_anew(monkeypatch):
    monkeypatch.setattr(tokens, "TABLE_CHUNKS", 3)
    table = tokens.ChunkTable(tokens.model_path())
    for text in ("one two three four", "five six seven", "one nine"):
        assert table.lookup([text])[0].to_pylist() == [table.model.encode(text)]


def shingles(text, n=5, lower=False):
    own = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}) if lower else (text or ""))
    return {tuple(own)} if 0 < len(own) < n else {tuple(own[i:i + n]) for i in range(len(own) - n + 1)}


def test_fingerprints(odd, none):
    found = every(odd, none, fingerprints.edited_likeness)
    rows = {(r.doc_id, r.n_chars): r for r in found}
    assert len(found) == len(odd_rows())
    order = sorted({(i, t or "") for i, t, _ in odd_rows()}, key=lambda r: (r[0] is None, -(r[0] or 0)))
    for k, (i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        n = len(t) // 3
        edited = t[:len(t) - n] + after[:n]
        r = rows[i, len(t)]
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = shingles(t), shingles(edited), shingles(after)
        if len(a | b) < 4 * 5:
            continue
        assert abs(r.near_edited - len(a & b) / len(a | b)) < 0.25
        assert abs(r.near_next - len(a & c) / max(1, len(a | c))) < 0.25
    assert len({r.fingerprint for r in found if r.doc_id == 1}) == 1
    assert rows[2, 0].fingerprint == ""


def test_sketches_merge_and_contain(spark):
    words = [f"w{k}" for k in range(4000)]
    rows = [(1, " ".join(words), "a"), (2, " ".join(words[500:900]), "a")]
    docs = documents(spark, rows)
    found = {r.doc_id: set(r.sketch) for r in fingerprints.fingerprints(docs, "doc_id").collect()}
    assert found[2] <= found[1]
    assert abs(len(found[1]) / 3996 - 1 / fingerprints.SCALE) < 0.04
    merged = fingerprints.merge(fingerprints.fingerprints(docs, "source", "doc_id"), "source")
    assert {r.hash for r in merged.collect()} == found[1] | found[2]


def toxic_rows(n):
    rng = random.Random(1)
    plain = ["".join(rng.choice("aeioudlmnrst") for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    rows = []
    for i in range(n):
        own = [rng.choice(plain) for _ in range(60)]
        toxic = i % 4 == 0
        if toxic:
            own[rng.randrange(60)] = rng.choice(["idiot", "worthless", "moronic"])
        rows.append((i, " ".join(own), toxic))
    return rows


def test_toxicity_held_out(spark):
    rows = toxic_rows(900)
    docs = documents(spark, [(i, t, "s") for i, t, _ in rows] + [(10_000, None, None), (None, "", "s"), (0, rows[0][1], "t")])
    labels = spark.createDataFrame([(i, 1, int(x)) for i, _, x in rows] + [(5, 1, None), (7, 0, 0)], "doc_id long, quality int, toxic int")
    found = toxicity.op3_toxicity(docs, labels).collect()
    assert len(found) == len(rows) + 3
    truth = {i: x for i, _, x in rows}
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found if r.doc_id is not None)
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)
    assert {r.predicted for r in found if r.doc_id in (None, 10_000)} == {0}
    kept = toxicity.stage_toxicity(docs, labels)
    assert kept.columns == docs.columns
    assert sum(truth.get(r.doc_id, False) for r in kept.collect()) <= 0.05 * len(rows)


def test_toxicity_without_labels(spark, odd, none):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = every(odd, none, lambda d: toxicity.op3_toxicity(d, labels))
    assert {r.score for r in found} == {0.5}


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], "page_id long, url string, html string, payload string, digest string")


def test_warc_round_trip(spark):
    same = "<p>" + "copy " * 50
    rows = [(3, "http://a/x", same), (1, "http://b/y\r\nz", same), (2, None, same), (4, "u", None), (5, "u", "small"), (6, "v", "small"),
            (7, "w", "é" * 300_000), (8, "w", "q" * 99), (9, "w", "q" * 99), (10, "w", "q" * 100), (11, "w", "q" * 100), (None, "n", "nothing known")]
    found = {r.page_id: r for r in warc.round_trip(pages(spark, rows)).collect()}
    assert len(found) == len(rows)
    for i, _, html in rows:
        payload = (html or "").encode()
        r = found[i]
        assert (r.payload_bytes, r.payload_digest) == (len(payload), hashlib.sha256(payload).hexdigest())
        assert r.payload == (payload if r.record_type == "response" else None)
    assert {i: r.refers_to for i, r in found.items() if r.record_type == "revisit"} == {2: 1, 3: 1, 11: 10}
    assert warc.round_trip(pages(spark, [])).count() == 0


def test_warc_text_ids_and_plain_paths(spark, tmp_path):
    """An empty text is an id, null is none; a path without a scheme lies in the default store."""
    rows = [("", "http://a/", "x" * 200), (None, "http://b/", "y" * 200), ("p", "http://c/", "x" * 200), (None, None, None)]
    table = spark.createDataFrame(rows, "page_id string, url string, html string")
    found = warc.round_trip(table, str(tmp_path / "plain")).collect()
    assert key([(r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in found]) == key(
        [("", "response", None, 200), (None, "response", None, 200), ("p", "revisit", "", 200), (None, "response", None, 0)])
    assert list((tmp_path / "plain").glob("*.warc.gz"))


def test_warc_rolls_over_and_rejects_damage(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"page {i} " * 40) for i in range(40)]
    planned = warc.plan_records(pages(spark, rows)).coalesce(1)
    archives = warc.write_archives(planned, str(tmp_path / "a"), archive_bytes=2000)
    assert archives.count() > 2 and archives.agg(F.sum("records")).first()[0] == 40
    assert warc.read_archives(archives).count() == 40
    place = archives.orderBy("path").first()["path"]
    data = bytearray(open(place, "rb").read())
    members = list(_split(bytes(data)))
    assert len(members) == archives.where(F.col("path") == place).first()["records"]

    class Stream:
        def __init__(self, data):
            self.data = data

        def read(self, n):
            out, self.data = self.data[:n], self.data[n:]
            return out

    for block in (1, 7, 1000):
        assert len([warc.parse(m) for m in warc.members(Stream(bytes(data)), block)]) == len(members)
    with pytest.raises(Exception):
        [warc.parse(m) for m in warc.members(Stream(bytes(data[:-9])), 64)]
    data[len(members[0]) // 2] ^= 0x55
    with pytest.raises(Exception):
        [warc.parse(m) for m in warc.members(Stream(bytes(data)), 64)]


def _split(data):
    while data:
        unpack = zlib.decompressobj(31)
        unpack.decompress(data)
        yield data[:len(data) - len(unpack.unused_data)]
        data = unpack.unused_data


def water(sizes, weights, most):
    """Targets by the exchange itself: what is above a cap goes to the others by weight, again and again."""
    total, capped = sum(sizes), {}
    while True:
        rest = [i for i in range(len(sizes)) if i not in capped]
        left = total - sum(capped.values())
        share = {i: left * weights[i] / sum(weights[j] for j in rest) for i in rest}
        over = {i: most * sizes[i] for i in rest if share[i] > most * sizes[i]}
        if not over:
            return [float(capped.get(i, share.get(i))) for i in range(len(sizes))]
        capped |= over
        if len(capped) == len(sizes):
            return [float(capped[i]) for i in range(len(sizes))]


def test_mixing(spark, odd, none):
    rng = random.Random(2)
    rows = [(i, " ".join("abcde" for _ in range(rng.randrange(1, 60))), rng.choice(["hot"] * 8 + ["b", "c", "d", "e", None])) for i in range(2000)]
    rows += [(3000, "tiny source", "a"), (3001, None, "b"), (3002, " ", None), (1, "abcde", "hot")]
    found = mixing.mix(documents(spark, rows)).collect()
    assert len(found) == len(rows)
    size = defaultdict(int)
    for _, t, s in rows:
        size[s] += len(WORD.findall(t or ""))
    names = sorted([s for s in size if s is not None]) + [None]
    targets = dict(zip(names, water([size[s] for s in names], [1 + k % 3 for k in range(len(names))], 3)))
    taken, source = defaultdict(int), {i: s for i, _, s in rows}
    for r in found:
        s = source[r.doc_id]
        assert r.source_size == size[s] and math.isclose(r.target, targets[s], rel_tol=1e-12)
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        taken[s] += r.taken
    assert all(abs(taken[s] - targets[s]) <= 60 for s in names)
    assert key(found) == key(mixing.mix(documents(spark, rows[::-1]).repartition(5)).collect())
    assert len(every(odd, none, mixing.op5_mixing)) == len(odd_rows())
    stage = mixing.stage_mix(odd)
    assert stage.columns == odd.columns and mixing.stage_mix(none).count() == 0


def test_heavier_documents_are_taken_more_often(spark):
    rows = [(i, "word word word word", "a" if i < 2000 else "b") for i in range(4000)]
    found = mixing.mix(documents(spark, rows), weight=F.when(F.col("doc_id") % 2 == 0, 4.0).otherwise(1.0)).where("doc_id < 2000").collect()
    even = sum(r.taken for r in found if r.doc_id % 2 == 0)
    assert even > 1.3 * sum(r.taken for r in found if r.doc_id % 2)


def test_running_sums_across_ranges(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 7 > 0, "b").alias("source"),
                                    (F.xxhash64("id") % 50).alias("key"), "id", (F.col("id") % 11).alias("size"))
    order = [F.col("key"), F.col("id")]
    found = common.running_before(rows, "source", order, "size", "test").select("id", "__before").collect()
    sums, expected = defaultdict(int), {}
    for r in sorted(rows.collect(), key=lambda r: (r["key"], r["id"])):
        expected[r["id"]] = sums[r["source"]]
        sums[r["source"]] += r["size"]
    assert {r["id"]: r["__before"] for r in found} == expected


def test_line_dedup(spark, odd, none):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        own = [f"line {i} {k} " + "pad " * 20 for k in range(4)]
        if i % 2 == 0:
            own.insert(rng.randrange(4), "  shared by all sites ")
        if i < 5:
            own.append("on five sites")
        if i % 40 == 0:
            own.append("on few documents")
        rows.append((i, "\n".join(own), f"s{i % 9}" if i >= 5 else f"s{i}"))
    rows += [(1000 + k, "copied first line\ncopied second line", f"s{k}") for k in range(9)]
    rows += [(2000, "shared by all sites", "s1"), (2001, None, None), (2002, "", "s2")]
    found = lines.dedup_lines(documents(spark, rows), least_sites=5)
    assert found.columns == documents(spark, rows).columns + ["__removed"]
    texts = {r.doc_id: r for r in found.collect()}
    once = {t: min(s for _, u, s in rows if u == t and s) for _, t, _ in rows if t}
    spread = defaultdict(set)
    for t, s in once.items():
        for x in t.split("\n"):
            spread[x.strip()].add(s)
    bad = {x for x, s in spread.items() if x and len(s) >= 5}
    assert "shared by all sites" in bad and "on five sites" in bad and "copied first line" not in bad
    for i, t, _ in rows:
        rest = None if t is None else "\n".join(x for x in t.split("\n") if x.strip() not in bad)
        if t and not rest.strip():
            rest = t
        assert texts[i].text == rest and texts[i].n_chars == (None if rest is None else len(rest))
    assert len(every(odd, none, lines.op6_line_dedup)) == len(odd_rows())


def test_line_dedup_by_default_in_small_corpora(spark):
    passage = " ".join(f"word{k}" for k in range(60))
    for sites in (3, 10, 19):
        rows = [(k, "\n".join([f"own line {k} {n} " + "pad " * 60 for n in range(4)] + [passage, "All rights reserved."]), f"s{k}") for k in range(sites)]
        found = {r.doc_id: r.text for r in lines.stage_line_dedup(documents(spark, rows)).collect()}
        bad = {passage} if sites == 3 else {passage, "All rights reserved."}  # short sentences need more sites
        assert found == {i: "\n".join(x for x in t.split("\n") if x not in bad) for i, t, _ in rows}


def test_line_dedup_cleans_documents_that_are_mostly_boilerplate(spark):
    passage = " ".join(f"word{k}" for k in range(60))
    rows = [(k, f"short text {k}\n{passage}\n", f"s{k}") for k in range(4)] + [(9, passage, "s9")]
    found = {r.doc_id: r.text for r in lines.stage_line_dedup(documents(spark, rows)).collect()}
    # a document without a line of its own stays
    assert found == {k: f"short text {k}\n" for k in range(4)} | {9: passage}


def test_line_dedup_counts_every_site_of_copies(spark):
    texts = [f"own line {k} " + "pad " * 20 + "\nfooter of many sites" for k in range(4)]
    rows = [(100 * k + s, t, f"s{s:02}") for k, t in enumerate(texts) for s in range(12)]
    # two texts on many sites are copies, not carriers
    rows += [(1000 + 100 * k + s, f"other {k}\nline of two texts", f"s{s:02}") for k in range(2) for s in range(12)]
    found = {r.doc_id: r.text for r in lines.stage_line_dedup(documents(spark, rows)).collect()}
    assert found == {i: t.removesuffix("\nfooter of many sites") for i, t, _ in rows}


def repeated(own):
    seen = Counter(tuple(own[k:k + 5]) for k in range(len(own) - 4))
    return len({j for k in range(len(own) - 4) if seen[tuple(own[k:k + 5])] > 1 for j in range(k, k + 5)})


def test_quality_statistics(spark, odd, none):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(40))), "s") for i in range(300)] + odd_rows()
    found = quality.statistics(documents(spark, rows), "doc_id").collect()
    expected = []
    for i, t, _ in rows:
        own, full = WORD.findall(t or ""), [x for x in (t or "").split("\n") if WORD.search(x)]
        expected.append((i, len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", t or "")), len(full) - len(set(full)), repeated(own)))
    assert key([(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found]) == key(expected)
    verdicts = every(odd, none, quality.op7_quality_rules)
    assert all(r.kept == (not r.base_failed) for r in verdicts)  # too few documents to reject any


def test_quality_outliers(spark):
    rng = random.Random(8)
    made = lambda n: " ".join("".join(rng.choice("aeiourstln") for _ in range(rng.randrange(2, 9))) for _ in range(n))
    rows = [(i, made(rng.randrange(30, 200)), "hot" if i % 3 else "b") for i in range(1200)]
    rows += [(2000 + i, " ".join(w + "***" for w in made(80).split()), "hot") for i in range(60)]
    rows += [(3000 + i, "\n".join([made(20)] * 3 + [made(12)]), "b") for i in range(20)]
    found = {r.doc_id: r for r in quality.judge(documents(spark, rows)).collect()}
    assert all(found[i].kept for i in range(1200))
    assert not any(found[2000 + i].kept for i in range(60)) and not any(found[3000 + i].kept for i in range(20))


def test_quality_of_small_sources(spark):
    rng = random.Random(9)
    made = lambda n: " ".join("".join(rng.choice("aeiourstln") for _ in range(rng.randrange(2, 9))) for _ in range(n))
    hot = [(i, made(rng.randrange(30, 200)), "hot") for i in range(600)]
    own = [(1000 + i, " ".join(w + "$" * (k % 2) for k, w in enumerate(made(rng.randrange(30, 200)).split())), "small") for i in range(200)]
    judged = lambda n: {r.doc_id: r for r in quality.judge(documents(spark, hot + own[:n])).collect()}
    few, less, more = judged(60), judged(199), judged(200)
    # the manner of a small source counts, and one more document changes little
    assert all(few[i].kept for i, _, _ in own[:60])
    assert all(abs(less[i].distance - more[i].distance) < 0.5 for i, _, _ in own[:199])
    assert all(less[i].kept == more[i].kept for i, _, _ in own[:199])


def test_chi_square_quantiles():
    assert math.isclose(quality.chi_square_quantile(0.95, 4), 9.487729, rel_tol=1e-6)
    assert math.isclose(quality.chi_square_quantile(0.75, 2), 2.772589, rel_tol=1e-6)


def test_url_rules(spark):
    rows = [(1, "http://a.net/x"), (2, "http://net/"), (3, "HTTP://Www.Example.NET/en/1?q"), (4, "http://example.net/enx"), (5, "http://xnet/"),
            (6, "https://example.com/de/1"), (7, "https://m.example.com/de"), (8, "ftp://a.org/fr/x#y"), (9, None), (10, "no scheme.net/"),
            (11, "x://y.net"), (12, "http://a.net?x=/"), (13, "http://user.net:80/p"), (None, "http://a.net/"), (1, "http://a.net/x")]
    found = urls.judge(spark.createDataFrame([(i, u, "x", "y") for i, u in rows], "page_id long, url string, host string, verdict string")).collect()
    assert len(found) == len(rows)
    got = {r.page_id: (r.host, r.path, r.rule) for r in found}
    assert got[1] == ("a.net", "/x", "net/") and got[2] == ("net", "/", "net/") and got[3] == ("www.example.net", "/en/1", "example.net/en/")
    assert got[4] == ("example.net", "/enx", "net/") and got[5] == ("xnet", "/", None) and got[6][2] == "example.com/de/" and got[7][2] is None
    assert got[8] == ("a.org", "/fr/x", "org/fr/") and got[9] == ("", "", None) and got[10] == ("", "", None)
    assert got[11] == ("y.net", "", None) and got[12] == ("a.net", "", None) and got[13] == ("user.net:80", "/p", None)
    empty = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge(empty).count() == 0


def test_mined_url_rules(spark):
    rng = random.Random(9)
    rows = []
    for i in range(1500):
        host = rng.choice(["shop", "news", "wiki", "farm"])
        path = rng.choice(["a", "b", "win"])
        rows.append((i, f"http://{host}{i % 7}.example.org/{path}/{i}", host == "farm" and path == "win"))
    frame = spark.createDataFrame([(i, u) for i, u, _ in rows], "page_id long, url string")
    labels = spark.createDataFrame([(i, int(not bad), 0) for i, _, bad in rows if i % 2], "doc_id long, quality int, toxic int")
    host, path = urls.host_path(F.col("url"))
    sets = frame.select("page_id", urls.tokens(host, path).alias("tokens"))
    labelled = sets.join(labels, F.col("page_id") == F.col("doc_id")).select("tokens", (F.col("quality") == 0).alias("blocked"))
    data = [(set(r.tokens), r.blocked) for r in labelled.collect()]
    for r in urls.mine(labelled, urls.token_names(labelled)).collect():
        inside = [b for t, b in data if set(r.antecedent) <= t]
        assert math.isclose(r.confidence, sum(inside) / len(inside)) and r.confidence >= urls.LEAST_CONFIDENCE
    verdicts = {r.page_id: r.verdict for r in urls.judge(frame, labels, rules=()).collect()}
    assert all((verdicts[i] == "block") == bad for i, _, bad in rows)


def brute_verdicts(addresses, labelled):
    """Verdicts from all combinations of the names of every labelled address."""
    from itertools import combinations

    sets = [(frozenset(t), b) for t, b in labelled if t]
    having = defaultdict(set)
    for k, (own, _) in enumerate(sets):
        for t in own:
            having[t].add(k)
    name = {t: min(u for u in having if having[u] == having[t]) for t in having}
    blocked = {k for k, (_, b) in enumerate(sets) if b}
    frequent = [t for t in having if name[t] == t and len(having[t]) >= urls.LEAST_SUPPORT * len(sets)]
    rank = lambda t: (-len(having[t] & blocked) / len(having[t]), len(having[t]), t)
    rules = {}
    for own, _ in set(sets):
        best = sorted((t for t in own if t in frequent), key=rank)[:urls.MOST_TOKENS]
        for n in range(1, len(best) + 1):
            rules.update(dict.fromkeys(frozenset(c) for c in combinations(best, n)))
    # baskets hold an address's best tokens only
    baskets = [(frozenset(sorted((t for t in own if t in frequent), key=rank)[:urls.MOST_TOKENS]), b) for own, b in sets]
    found = set()
    for rule in rules:
        inside = [b for own, b in baskets if rule <= own]
        if sum(inside) >= urls.LEAST_SUPPORT * len(sets) and sum(inside) >= urls.LEAST_CONFIDENCE * len(inside):
            found.add(rule)
    return ["block" if any(rule <= {name[t] for t in own if t in name} for rule in found) else "allow" for own in addresses]


def test_url_verdicts_equal_brute_force(spark):
    rng = random.Random(21)
    rows = []
    for i in range(500):
        parts = rng.sample(["a", "b", "c", "win", "free", "x", "news"], rng.randrange(1, 5))
        bad = {"win", "free"} <= set(parts) or ("x" in parts and rng.random() < 0.95)
        rows.append((i, f"http://h{rng.choice('pq')}.example.org/" + "/".join(parts + (["both", "always"] if "c" in parts else [])), bad))
    frame = spark.createDataFrame([(i, u) for i, u, _ in rows], "page_id long, url string")
    labels = spark.createDataFrame([(i, int(not bad), 0) for i, _, bad in rows if i % 3], "doc_id long, quality int, toxic int")
    host, path = urls.host_path(F.col("url"))
    own = {r.page_id: r.t for r in frame.select("page_id", urls.tokens(host, path).alias("t")).collect()}
    expected = brute_verdicts([own[i] for i, _, _ in rows], [(own[i], bad) for i, _, bad in rows if i % 3])
    got = {r.page_id: r.verdict for r in urls.judge(frame, labels, rules=()).collect()}
    assert [got[i] for i, _, _ in rows] == expected and {"block", "allow"} == set(expected)


@pytest.mark.parametrize("shared", [14, 40])
def test_url_mining_is_bounded(spark, shared):
    """Pages that share many path words, all or most of them, make no more combinations than ten words do."""
    rng = random.Random(3)
    words = [f"word{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(shared)]
    rows = [(i, "http://a.example.org/" + "/".join(w for w in words if rng.random() < 0.97), True) for i in range(40)]
    rows += [(100 + i, f"http://b.example.org/other/{words[i % shared]}", False) for i in range(400)] + [(900, "http://c.example.org/" + "/".join(["very"] * 3000), False)]
    frame = spark.createDataFrame([(i, u) for i, u, _ in rows], "page_id long, url string")
    labels = spark.createDataFrame([(i, int(not bad), 0) for i, _, bad in rows], "doc_id long, quality int, toxic int")
    verdicts = {r.page_id: r.verdict for r in urls.judge(frame, labels, rules=()).collect()}
    assert all((verdicts[i] == "block") == bad for i, _, bad in rows)


def mined_rules(spark, rows, **how):
    labelled = spark.createDataFrame([(sorted(own), bad) for own, bad in rows], "tokens array<string>, blocked boolean")
    found = urls.mine(labelled, urls.token_names(labelled), **how).collect()
    assert len(found) == len({tuple(r.antecedent) for r in found})
    return {tuple(r.antecedent): (round(r.confidence, 12), round(r.support, 12), r.index_token) for r in found}


def test_long_addresses_are_mined_whole(spark):
    """Two words say block together; twelve others of the same addresses are blocked more often, and never surely."""
    many = [f"d{chr(97 + i)}" for i in range(12)]
    path = {}
    path |= {i: (many + ["uu", "vv"], True) for i in range(30)}
    path |= {100 + i: (many, False) for i in range(10)}
    path |= {200 + i: ([many[i % 12]], True) for i in range(60)}
    path |= {300 + i: (["uu" if i % 2 else "vv"], False) for i in range(60)}
    path |= {400: (["uu", "vv"], None), 401: (many[:11], None), 402: (many[:1] + ["vv"], None)}
    frame = spark.createDataFrame([(i, "http://a.example.org/" + "/".join(p)) for i, (p, _) in path.items()], "page_id long, url string")
    labels = spark.createDataFrame([(i, int(not bad), 0) for i, (_, bad) in path.items() if bad is not None], "doc_id long, quality int, toxic int")
    got = {r.page_id: (r.verdict, r.confidence) for r in urls.judge(frame, labels, rules=()).collect()}
    assert got[0] == got[400] == got[402] == ("block", 1.0)
    assert {got[i] for i in path if i not in range(30) and i not in (400, 402)} == {("allow", None)}


def test_rules_of_long_addresses_equal_those_of_fp_growth(spark):
    rng = random.Random(5)
    rows = []
    for _ in range(300):
        own = set(rng.sample("abcdefgh", rng.randrange(1, 7)))
        own |= {"twin"} if "a" in own else set()
        rows.append((own, (rng.random() < 0.97) if {"b", "c"} <= own or "d" in own and "a" not in own else rng.random() < 0.3))
    for confidence in (0.5, 0.9):
        whole = mined_rules(spark, rows, least_support=0.02, least_confidence=confidence)
        assert whole == mined_rules(spark, rows, least_support=0.02, least_confidence=confidence, most_tokens=0)
        assert whole and max(map(len, whole)) > 1


def test_toxicity_equals_brute_force(spark):
    """Scores follow from chi-square, log-count ratios and a weighted logistic regression solved by Newton's method."""
    rng = random.Random(31)
    made = lambda bad: " ".join(rng.choice(["house", "tree", "river", "cloud", "stone", *(["vile", "filth"] if bad else ["calm"])]) for _ in range(12))
    rows = [(i, made(i % 4 == 0), "s") for i in range(240)]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(200)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model, "doc_id").collect()}
    grams = {i: set(toxicity.buckets(t).tolist()) for i, t, _ in rows}
    train = [(grams[i], int(i % 4 == 0)) for i in range(200)]
    n1 = sum(y for _, y in train)
    n0 = len(train) - n1
    kept = []
    for g in sorted(set().union(*(own for own, _ in train))):
        a, b = (sum(g in own for own, y in train if y == k) for k in (0, 1))
        c, d = n0 - a, n1 - b
        if (n0 + n1) * (a * d - b * c) ** 2 / (n0 * n1 * (a + b) * max(c + d, 0.5)) >= toxicity.LEAST_CHI2:
            kept.append((g, math.log((b + 1) / (n1 + 2)) - math.log((a + 1) / (n0 + 2))))
    x = np.array([[r if g in own else 0.0 for g, r in kept] + [1.0] for own, _ in train])
    y = np.array([k for _, k in train], float)
    weight = np.where(y == 1, n0 / n1, 1.0)
    weight /= weight.sum()
    penalty = np.diag([1e-4] * len(kept) + [0.0])
    beta = np.zeros(len(kept) + 1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-x @ beta))
        gradient = x.T @ (weight * (p - y)) + penalty @ beta
        beta -= np.linalg.solve(x.T @ (x * (weight * p * (1 - p))[:, None]) + penalty + 1e-12 * np.eye(len(beta)), gradient)
    for i, _, _ in rows:
        z = sum(r * w for (g, r), w in zip(kept, beta) if g in grams[i]) + beta[-1]
        assert abs(got[i] - 1 / (1 + math.exp(-z))) < 0.01
    # a text of the toxic kind may hold none of its words
    assert sum((got[i] >= 0.5) == (i % 4 == 0) for i in range(240)) > 220


def test_quality_estimate_equals_brute_force(spark):
    """Concentration steps on one group, until its core stays the same."""
    rng = np.random.default_rng(4)
    p = len(quality.NAMES)
    points = np.round(quality.UNIT * np.concatenate([rng.normal([2, 0.5, 0.3, 0.4], 0.5, (260, p)), rng.normal(6, 0.4, (50, p))])).astype(int)
    rows = spark.createDataFrame([(0, "g", *map(int, q)) for q in points], "level int, group string, " + ", ".join(f"q{i} long" for i in range(p)))
    found = quality.estimate(rows, 1).first()
    x, floors = points / quality.UNIT, np.array(quality.FLOORS)
    centre = np.median(x, axis=0)
    shape = np.diag((1.4826 * np.median(np.abs(x - centre), axis=0)) ** 2 + floors**2)
    core = None
    while True:
        d2 = np.einsum("ni,ij,nj->n", x - centre, np.linalg.inv(shape), x - centre)
        step = np.floor(64 * np.log2(d2 + 1e-6))
        now = step <= np.percentile(step, 100 * quality.CORE)
        if core is not None and (now == core).all():
            break
        core = now
        centre = x[core].mean(axis=0)
        shape = np.cov(x[core].T, bias=True) + np.diag(floors**2)
    assert all(math.isclose(found[f"m{i}"], centre[i], abs_tol=1e-9) for i in range(p))
    assert all(math.isclose(found[f"v{i}_{j}"], shape[i, j], abs_tol=1e-9) for i in range(p) for j in range(i + 1))
    assert not core[260:].any()


def test_class_scores_follow_from_classes(spark):
    """Given the classes, transitions, emissions and scores are counted out by hand; probabilities add up to one."""
    rng = random.Random(17)
    rows = [(i, " ".join(rng.choice([f"n{rng.randrange(30)}", f"v{rng.randrange(30)} the"]) for _ in range(rng.randrange(40))), "s") for i in range(200)]
    docs, held = documents(spark, rows), rows[:20] + [(900, "n1 unseen the n2", "s"), (901, None, "s")]
    counts, words, model = lm.train(docs)
    place = {int(h): k for k, h in enumerate(words.hashes)}

    def classes_of(text):
        h, group = lm.tokens(text)
        return [int(model.classes[place[int(x)]]) if int(x) in place else int(model.endings[g]) for x, g in zip(h, group)], [int(x) for x in h]

    steps, seen, size, types = np.zeros((lm.CLASSES, lm.CLASSES)), Counter(), Counter(), defaultdict(set)
    for _, t, _ in rows:
        own, h = classes_of(t)
        for before, c, x in zip(own[-1:] + own[:-1], own, h):
            steps[before, c] += 1
            seen[x] += 1
            size[c] += 1
            types[c].add(x)
    forward = (steps + 0.5) / (steps.sum(axis=1) + 0.5 * lm.CLASSES)[:, None]
    emission = lambda c, x: (seen[x] + 0.5) / (size[c] + 0.5 * (len(types[c]) + 1))
    got = {r.doc_id: r.score for r in lm.score(documents(spark, held), counts, words, model).collect()}
    for i, t, _ in held:
        own, h = classes_of(t or "")
        expected = sum(math.log10(forward[b, c] * emission(c, x)) for b, c, x in zip(own[-1:] + own[:-1], own, h))
        assert math.isclose(got[i], expected, rel_tol=1e-9), (i, got[i], expected)
    # after any class: all words of all classes, and one unseen word in each
    assert np.allclose([sum(forward[b, c] * (sum(emission(c, x) for x in types[c]) + emission(c, -1)) for c in range(lm.CLASSES)) for b in range(4)], 1)


def test_words_settle_where_their_neighbours_say(spark):
    """Words in the place of nouns and of verbs come into classes of their own, however they end."""
    rng = random.Random(19)
    made = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    nouns, verbs = [made() for _ in range(60)], [made() for _ in range(60)]
    rows = [(i, " ".join(f"the {rng.choice(nouns)} {rng.choice(verbs)} a {rng.choice(nouns)} ." for _ in range(15)), "s") for i in range(300)]
    _, words, model = lm.train(documents(spark, rows))
    place = {int(h): k for k, h in enumerate(words.hashes)}
    own = lambda w: int(model.classes[place[int(lm.tokens(w)[0][0])]])
    assert not {own(w) for w in nouns} & {own(w) for w in verbs}


def test_class_model(spark, odd, none):
    rng = random.Random(11)
    nouns, verbs = [f"n{k}" for k in range(40)], [f"v{k}" for k in range(40)]
    rows = [(i, " ".join(f"The {rng.choice(nouns)} {rng.choice(verbs)} a {rng.choice(nouns)} ." for _ in range(12)), "s") for i in range(300)]
    rows += [(i, t, s) for i, t, s in odd_rows() if i not in (1,)] + [(20, "twice", "s"), (20, "twice", "s")]
    docs = documents(spark, rows)
    found = lm.op9_class_model(docs).collect()
    split = {}
    count = Counter()
    for i, t, _ in rows:
        own = [w.lower() for w in re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())] + [b""]
        split[i, t] = own
        if zlib.crc32(b"" if i is None else str(i).encode()) % 5 != 1:
            count.update(own)
    n, v = sum(count.values()), len(count)
    base = lambda own: sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
    expected = [(i, len(split[i, t]), sum(count[w] > 0 for w in split[i, t]), n, round(base(split[i, t]), 6)) for i, t, _ in rows]
    assert key([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found]) == key(expected)
    held = [r for r in found if r.held_out and r.doc_id is not None and 100 < r.doc_id < 300]
    assert sum(r.score for r in held) > 0.8 * sum(r.base_score for r in held)  # the order of word classes is worth over a fifth
    assert len(every(odd, none, lm.op9_class_model)) == len(odd_rows())


def test_class_model_is_a_distribution(spark):
    rng = random.Random(12)
    rows = [(i, " ".join(rng.choice(["aa", "bb", "cc", "dd", "ee"]) for _ in range(30)), "s") for i in range(50)]
    counts, words, model = lm.train(documents(spark, rows))
    assert np.allclose((10 ** model.steps).sum(axis=1), 1)
    own = model.classes
    for c in set(own):
        inside = (words.counts[own == c] + 0.5).sum() + 0.5  # and what is left for unknown words
        assert math.isclose(math.log10(inside), model.sizes[c], rel_tol=1e-9)


def linked_groups(rows, n, percent):
    sets = {i: frozenset(shingles(t, n, lower=True)) for i, t in rows}
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i)) for i in sets}


@pytest.mark.parametrize("n, percent, small", [(3, 90, 2000), (5, 80, 2000), (2, 60, 2000), (3, 90, 3), (2, 60, 3)])
def test_jaccard_groups(spark, monkeypatch, n, percent, small):
    """Groups equal brute force, with clusters joined in one task and, beyond ``small`` sets, by pivots."""
    monkeypatch.setattr(jaccard, "SMALL_SETS", small)
    rng = random.Random(n)
    words = [f"W{k}" for k in range(300)]
    rows = []
    for _ in range(18):
        size = rng.choice([2, 4, 7, 12, 25, 60, 150])
        base = [rng.choice(words) for _ in range(size)]
        for _ in range(rng.choice([1, 2, 5, 25])):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                own[rng.randrange(size)] = rng.choice(words)
            rows.append((len(rows), " ".join(own).swapcase() if rng.random() < 0.2 else " ".join(own)))
    rows += [(900, ""), (901, None), (902, " \t"), (903, "one"), (904, "ONE")]
    found = jaccard.jaccard_join(documents(spark, [(i, t, "s") for i, t in rows]), n, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == linked_groups(rows, n, percent)


def test_jaccard_odd_rows(odd, none):
    found = every(odd, none, jaccard.jaccard_join)
    assert len(found) == len(odd_rows())
    assert all(r.component_id == r.doc_id for r in found)
    kept = jaccard.stage_near_duplicates(odd)
    # one row is there twice
    assert kept.columns == odd.columns and kept.count() == len(odd_rows()) - 1
    assert jaccard.stage_near_duplicates(none).count() == 0


def test_jaccard_links_through_a_row_without_id(spark):
    words = [f"w{i}" for i in range(120)]
    a, n, b = words, words[:60] + ["p", "q"] + words[62:], words[:60] + ["p", "q"] + words[62:90] + ["r"] + words[91:]
    rows = [(1, " ".join(a), "s"), (None, " ".join(n), "s"), (2, " ".join(b), "s")]
    found = {r.doc_id: r.component_id for r in jaccard.jaccard_join(documents(spark, rows), 5, 90).collect()}
    assert found == {1: 1, None: None, 2: 1}
    # not without it
    assert {r.doc_id: r.component_id for r in jaccard.jaccard_join(documents(spark, [rows[0], rows[2]]), 5, 90).collect()} == {1: 1, 2: 2}


def test_one_row_of_each_group_stays(spark):
    """Repeated ids, null ids, two texts of one id: one row stays of each group, and all without words."""
    words = [f"w{i}" for i in range(100)]
    text, near, other = " ".join(words), " ".join(words[:97] + ["x", "y", "z"]), " ".join(words[::-1])
    rows = [(5, text, "a"), (5, text, "b"), (None, text, "a"), (None, near, "a"), (5, near, "a"), (7, other, "a"), (None, other, "b"),
            (None, "only without id", "a"), (None, "only without id", "a"), (8, "", "a"), (8, "", "a"), (None, None, "a")]
    kept = jaccard.stage_near_duplicates(documents(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.text or "") for r in kept if r.doc_id != 5) == sorted(
        [("7", other), ("None", "only without id"), ("8", ""), ("8", ""), ("None", "")])
    assert [r.text in (text, near) for r in kept if r.doc_id == 5] == [True]


def test_mixing_takes_rows_by_source(spark):
    """Rows with null or repeated ids and equal sizes in several sources: each source is taken as often as the mix says."""
    rows = [(None, f"one two three {k}", "a") for k in range(3)] + [(None, "a b c d", "b")] + [(4, "u v w x", "a"), (4, "u v w x", "b"), (4, "u v w x", "b")]
    rows += [(100 + k, "many words here now", "c") for k in range(30)] + [(None, "e f g h", None)] * 2
    docs = documents(spark, rows)
    expected = Counter()
    for r in mixing.mix(docs).collect():
        expected[r.source] += r.copies
    assert Counter(r.source for r in mixing.stage_mix(docs).collect()) == +expected


def test_linked_sets_share_a_pivot():
    rng = random.Random(13)
    for percent in (60, 80, 90):
        for _ in range(300):
            size = rng.randrange(2, 400)
            base = [str(k) for k in rng.sample(range(10**6), size)]
            other = base[:max(1, round(size * rng.uniform(percent / 100, 1)))] + [str(k) for k in rng.sample(range(10**6), rng.randrange(1 + size // 10))]
            a, b = shingle_set(" ".join(base), 1), shingle_set(" ".join(other), 1)
            frequent = np.sort(rng.sample(a.tolist(), len(a) // 2)).astype(np.uint64)
            common = len(np.intersect1d(a, b))
            if 100 * common >= percent * (len(a) + len(b) - common):
                assert np.intersect1d(jaccard.set_pivots(a, percent, frequent)[0], jaccard.set_pivots(b, percent, frequent)[0]).size


def test_frequent_shingles_change_no_result(spark, monkeypatch):
    """A line in every text, few shingles counted as frequent or many, small regions or large ones."""
    rng = random.Random(14)
    rows = []
    for _ in range(60):
        own = [rng.choice("abcdefgh") + str(rng.randrange(40)) for _ in range(rng.randrange(3, 30))]
        for _ in range(rng.choice([1, 1, 3])):
            rows.append((len(rows), " ".join(own[:len(own) - rng.randrange(2)]) + " one line that all texts have at their end"))
    docs, expected = documents(spark, [(i, t, "s") for i, t in rows]), linked_groups(rows, 3, 80)
    for texts, region in ((20, 100), (3, 5), (10**9, 2)):
        monkeypatch.setattr(jaccard, "FREQUENT_TEXTS", texts)
        monkeypatch.setattr(jaccard, "SMALL_REGION", region)
        found = jaccard.jaccard_join(docs, 3, 80).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected


def test_components_of_long_chains(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, 200), (200, 150), (150, 100), (300, 301)]
    found = jaccard.components(spark.createDataFrame(edges, "a long, b long")).collect()
    roots = {r.node: r.root for r in found}
    assert all(roots[k] == 0 for k in range(1, 61)) and roots[200] == roots[150] == 100 and roots[301] == 300
