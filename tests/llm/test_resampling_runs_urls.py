"""Importance resampling, periodic runs and URL filters by brute force and on odd tables."""

import hashlib
import math
import re
import time
import zlib
from collections import Counter

import numpy as np

from formfields.llm import entries
from formfields.llm import importance_resampling as I
from formfields.llm import periodic_runs as R
from formfields.llm import url_filters as U

SCHEMA = "doc_id long, text string, score double, rank string, tie int, at string, collapsed string, `rest of url` string"


def docs(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, 0.5, "r", 1, "a", "c", "u") for i, t in rows], SCHEMA).repartition(parts)


def slow_features(text, width):
    words = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())
    return len(words), [b" ".join(words[i : i + n]) for n in range(1, width + 1) for i in range(len(words) - n + 1)]


def test_crcs_of_all_substrings():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 3 * I.ROW + 17).astype(np.uint8)
    at = np.sort(rng.integers(0, len(data) + 1, 400))
    got = I.running_crcs(data, np.concatenate((at, [0, I.ROW, len(data)])))
    assert got.tolist() == [zlib.crc32(data[:k].tobytes()) for k in [*at.tolist(), 0, I.ROW, len(data)]]
    first, last = at[:200], at[200:]
    part = got[200:400] ^ I.shifted(got[:200], last - first)
    assert part.tolist() == [zlib.crc32(data[i:j].tobytes()) for i, j in zip(first, last, strict=True)]


def slow_resample(rows, target, percent, least, seed, width, buckets):
    bucket = lambda f: zlib.crc32(f) % buckets
    found = [(i, *slow_features(t, width)) for i, t in rows]
    s = Counter(bucket(f) for _, _, fs in found for f in fs)
    t = Counter(bucket(f) for text in target for f in slow_features(text, width)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets))))
    out = []
    for i, n, fs in found:
        weight = sum(gain(bucket(f)) for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, n, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = able[: percent * len(able) // 100]
    rank = Counter()
    return out, [(r[0], r[4], k) for k, r in enumerate(drawn, 1)], rank


def test_resampling_by_brute_force(spark):
    rng = np.random.default_rng(2)
    words = [f"w{k}" for k in range(60)] + ["Äpfel", "ÉCOLE", "日本"]
    rows = [(i, " - ".join(rng.choice(words, rng.integers(0, 40)))) for i in range(120)]
    rows += [(None, "w1 w2 w3 w4 w5 w6"), (500, None), (501, ""), (7, rows[7][1]), (502, "w3 " * 30000)]
    target = [" ".join(rng.choice(words[:20], 30)) for _ in range(6)] + [None, ""]
    for width, percent in ((2, 25), (3, 60)):
        got = I.resample(docs(spark, rows), spark.createDataFrame([(t, 1) for t in target], "text string, rank int"), percent, 5, 3, width, 97).collect()
        every, drawn, _ = slow_resample(rows, target, percent, 5, 3, width, 97)
        assert Counter((r["doc_id"], r["n_features"], r["weight"], r["score"]) for r in got) == Counter((i, n, w, s) for i, _, n, w, s in every)
        assert sorted((r["rank"], r["doc_id"], r["score"]) for r in got if r["rank"]) == [(k, i, s) for i, s, k in drawn]


def test_resampling_of_empty_tables(spark):
    none = spark.createDataFrame([], "text string")
    assert I.resample(docs(spark, []), none).count() == 0
    got = I.resample(docs(spark, [(1, "a b c"), (2, None)]), none, 100, 1).collect()
    assert sorted((r["doc_id"], r["n_features"], r["rank"]) for r in got) == [(1, 5, 1), (2, 0, None)]


def slow_runs(words, times=4, least=6):
    n, out = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if length >= max(least, times * q):
                out.setdefault((start, length), q)
            i += i == start
    return sorted((s, n, q) for (s, n), q in out.items())


def test_runs_by_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a " * 9), (4, "a b " * 6 + "c"), (4, "a b " * 6 + "c"), (5, "x " + "a a b " * 5 + "a a a a a a"), (6, "é è\x0bé è\x0cé è é è")]
    for k in range(10, 150):
        words = rng.integers(0, rng.integers(2, 6), rng.integers(1, 90))
        if k % 3:
            p, a = int(rng.integers(1, 9)), int(rng.integers(0, len(words)))
            words[a:] = np.resize(words[a : a + p], len(words) - a)
        rows.append((k, " ".join(f"w{w}" for w in words)))
    got = Counter((r["doc_id"], r["n_words"], tuple(tuple(x) for x in r["runs"]), r["collapsed"]) for r in R.find_runs(docs(spark, rows)).collect())
    want = Counter()
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs = slow_runs(words)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        want[i, len(words), tuple(runs), " ".join(w for k, w in enumerate(words) if k not in gone)] += 1
    assert got == want
    assert any(len({q for _, _, q in key[2]}) > 1 for key in want)
    assert R.find_runs(docs(spark, [])).count() == 0


def test_segments_are_stable_and_hold_all_runs():
    rng = np.random.default_rng(4)
    for _ in range(50):
        codes = rng.integers(0, 12, 300)
        codes[100:140] = np.resize(codes[100:103], 40)
        segments = R.split_segments(codes, np.array([0, 150, 300]), 4, 6)
        for lo, hi in segments:
            assert min(Counter(codes[lo:hi].tolist()).values()) >= 4 and hi - lo >= 6 and not lo < 150 < hi
        for a in (0, 150):
            for s, n, _ in slow_runs(codes[a : a + 150].tolist()):
                assert any(lo <= a + s and a + s + n <= hi for lo, hi in segments)


def test_long_texts_of_repeated_words_are_scanned_in_time():
    began = time.time()
    one = R.runs_of([[b"word"] * 1_000_000], 4, 6)[0].tolist()
    assert one == [[0, 1_000_000, 1]]
    # Every round takes the word at the left end away, so that splitting alone would look at the whole text again and again.
    peeled = [b"t1", b"z"] + [w for k in range(1, 60000) for w in (b"t%d" % (k + 1), b"t%d" % k, b"t%d" % k, b"t%d" % k)]
    assert R.runs_of([peeled], 4, 6)[0].tolist() == []
    assert time.time() - began < 60


def test_planted_periods():
    words = [b"%d" % k for k in range(50)]
    k = next(k for k in range(1000) if zlib.crc32(str(k).encode()) % 10 == 0 and zlib.crc32(str(k).encode()) // 10 % 8 == 5)
    got, g = entries.with_periods(k, words), zlib.crc32(str(k).encode()) // 10
    a = g % 50
    p = 1 + (50 - a) // (3 + g % 8)
    assert got == [words[i if i < a else a + (i - a) % p] for i in range(50)]
    assert entries.with_periods(k, []) == [] and entries.with_periods(None, words) == words


def test_hosts_paths_and_rules(spark):
    cases = {
        "https://WWW.Example.com/en/a?x=/b#c": ("www.example.com", "/en/a", "www.example.com/en/", "allow"), "http://m.example.com/en/1": ("m.example.com", "/en/1", "example.com/en/", "block"),
        "http://notexample.com/en/1": ("notexample.com", "/en/1", "com/", "allow"), "http://com/x": ("com", "/x", "com/", "allow"), "http://a.net/es/": ("a.net", "/es/", "net/es/", "block"), "http://a.net/es": ("a.net", "/es", None, None),
        "http://a.org?x": ("a.org", "", None, None), "http://b.com": ("b.com", "", None, None), "//b.com/x": ("", "", None, None), None: ("", "", None, None), "": ("", "", None, None), "x://y://z/w": ("y:", "//z/w", None, None), "http://É.org/É": ("É.org", "/É", None, None),
    }
    got = U.with_rule(U.with_parts(spark.createDataFrame([(u,) for u in cases], "url string")), U.URL_RULES).collect()
    assert {r["url"]: (r["host"], r["path"], r["rule"], r["rule_verdict"]) for r in got} == cases
    assert U.with_rule(U.with_parts(spark.createDataFrame([("http://a.com/",)], "url string")), []).first()["rule"] is None


def test_tree_of_a_host_with_good_and_bad_branches(spark):
    rows, labels = [], []
    add = lambda url, bad=None: (rows.append((len(rows), f"http://h.org{url.replace('N', str(len(rows)))}")), labels.append((len(labels), bad)) if bad is not None else labels.append((len(labels), None)))
    for k in range(60):
        add("/spam/N.html", True)
        add("/news/N.html", k % 10 == 0)
        add("/blog/N.html", k % 9 == 0)
        add(f"/{chr(97 + k % 26)}{chr(97 + k // 26)}x/N.html", k % 12 == 0)
    for k in range(30):
        add("/spam/N.html")
        add("/news/N.html")
    deep = len(rows)
    rows += [(deep, "http://h.org" + "/a" * 50 + "/N"), (deep + 1, None), (None, "http://h.org/spam/77777.html"), (deep + 3, "http://other.org/spam/9")]
    pages = spark.createDataFrame([(i, u, "x", "y", 1) for i, u in rows], "page_id long, url string, shape string, host string, n int").repartition(3)
    known = spark.createDataFrame(labels + [(0, True), (None, True)], "number long, bad boolean")
    parts = U.with_shape(U.with_parts(pages.select("page_id", "url"))).selectExpr("host", "shape", "try_cast(nullif(regexp_extract(path, '[0-9]+', 0), '') AS bigint) AS number")
    tree = {(r["host"], r["shape"]): r for r in U.path_tree(parts, known).collect()}
    assert tree["h.org", "/spam/*.html"]["template"].startswith("/spam/") and tree["h.org", "/spam/*.html"]["rejected"]
    # News and blog are unlike their siblings together, spam among them, and like each other.
    assert tree["h.org", "/news/*.html"]["template"].split("/")[1] == tree["h.org", "/blog/*.html"]["template"].split("/")[1] == "~good"
    assert tree["h.org", "/aax/*.html"]["template"].startswith("/*/") and not tree["h.org", "/aax/*.html"]["rejected"]
    assert tree["h.org", "/a/a/a/a/a/a/**"]["template"].startswith("/*") and tree["h.org", "/spam/*.html"]["n"] == 91
    for rules in ([], U.URL_RULES):
        got = U.judge_urls(pages, known, rules).collect()
        assert len(got) == len(rows)
        assert all((r["verdict"] == "block") == (r["host"] == "h.org" and r["path"].startswith("/spam/")) for r in got)
    assert {r["verdict"] for r in U.judge_urls(pages, known.limit(0), []).collect()} == {"allow"}
    assert U.judge_urls(pages.limit(0), known, U.URL_RULES).count() == 0


def test_like_branches_are_merged(spark):
    paths = spark.createDataFrame([("h", f"/{s}/*", 100, 50, b) for s, b in (("en", 10), ("de", 11), ("fr", 9), ("xx", 45))] + [("h", f"/v{c}/*", 1, 1, 0) for c in "abcdef"], "host string, shape string, n long, labelled long, bad long")
    got = {r["shape"]: r["template"] for r in U.templates(paths).collect()}
    assert got["/xx/*"].startswith("/xx/") and {got[f"/{s}/*"].split("/")[1] for s in ("en", "de", "fr")} == {"~good"}
    assert {got[f"/v{c}/*"].split("/")[1] for c in "abcdef"} == {"*"}
    # Without the odd one out the rest is one branch.
    alike = {r["shape"]: r["template"] for r in U.templates(paths.where("shape <> '/xx/*'")).collect()}
    assert {alike[f"/{s}/*"] for s in ("en", "de", "fr")} == {"/~/~"}
