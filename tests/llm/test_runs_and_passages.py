"""Operators 12 and 13 against brute force on small, awkward tables."""

import hashlib
import re
import zlib

import numpy as np
import pytest

from reelstats.llm import decontaminate, periodic_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NORMAL = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
EXTRA = "lang string, runs string, hits long, item string"


def brute_runs(w, min_length=12):
    """All maximal stretches by trying every period."""
    n, found = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(min_length, 2 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def sequences():
    rng = np.random.RandomState(3)
    yield "same", [0] * 60
    yield "junction", ([0, 1] * 30 + [0]) * 2
    yield "junctions", ([0, 1] * 9 + [0]) * 5 + [2] + ([0, 1, 1] * 20 + [0]) * 4
    a, b = [0], [0, 1]
    while len(b) < 300:
        a, b = b, b + a
    yield "fibonacci", b
    t = [0]
    while len(t) < 256:
        t += [1 - x for x in t]
    yield "thue-morse", t
    yield "thue-morse twice", t * 2 + t[:77]
    for size in (2, 3, 5):
        for n in (5, 40, 400):
            yield f"random {size} {n}", rng.randint(0, size, n).tolist()
    for p in (17, 33, 40, 64, 65, 130):
        base = rng.randint(0, 50, p).tolist()
        yield f"period {p}", rng.randint(0, 50, 30).tolist() + (base * 3)[: 2 * p + p // 2] + rng.randint(0, 50, 20).tolist()
        yield f"exactly two of {p}", [99] + base * 2 + [98]
        yield f"one short of two of {p}", [99] + (base * 2)[:-1] + [98]
        inner = ([0, 1, 2] * p)[:p]
        yield f"periodic period {p}", [9] * 7 + (inner + [7]) * 4
        yield f"periodic period, bare {p}", inner * 2


@pytest.mark.parametrize("lags", [2, 4, 16])
def test_runs_equal_brute_force(lags):
    named = list(sequences())
    counts = np.array([len(s) for _, s in named])
    row, start, length, period = periodic_runs.find_runs(np.array([w for _, s in named for w in s]), counts, lags=lags)
    for r, (name, s) in enumerate(named):
        got = sorted(zip(start[row == r].tolist(), length[row == r].tolist(), period[row == r].tolist()))
        assert got == brute_runs(s), name


def test_runs_of_random_words_hold_every_scale():
    rng = np.random.RandomState(8)
    for _ in range(60):
        n = rng.randint(1, 200)
        s = rng.randint(0, 2, n).tolist()
        cut = rng.randint(0, n)
        s = (s[cut:] * rng.randint(1, 5) + s)[:260]
        _, start, length, period = periodic_runs.find_runs(np.array(s), np.array([len(s)]), lags=2)
        assert list(zip(start.tolist(), length.tolist(), period.tolist())) == brute_runs(s)


def planted(i, w):
    h = 1 if i is None else zlib.crc32(str(i).encode())
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
    return w


def report(i, text):
    w = planted(i, WORD.findall(text or ""))
    runs = brute_runs(w)
    gone = {k for s, m, q in runs for k in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    kept = " ".join(x for k, x in enumerate(w) if k not in gone)
    return (i, len(runs), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


TEXTS = [None, "", " \n\t", "one", "go " * 40, "naïve  日本 語 x " * 9 + "end", "a b " * 30 + "a " + "a b " * 30, "Aa aA " * 20, "x" * 9000]


def test_run_report(spark):
    rng = np.random.RandomState(1)
    rows = [(k, TEXTS[k % len(TEXTS)]) for k in range(60)] + [(k, " ".join(f"w{x}" for x in rng.randint(0, 30, rng.randint(1, 300)))) for k in range(100, 190)]
    rows += [(None, "a b c d " * 10), (None, None), (5, "z " * 50), (5, "z " * 50)]
    docs = spark.createDataFrame([(i, t, "l", "r", 1, "") for i, t in rows], f"doc_id long, text string, {EXTRA}").repartition(3)
    got = [tuple(r) for r in periodic_runs.run_report(docs).collect()]
    assert sorted(got, key=repr) == sorted((report(i, t) for i, t in rows), key=repr)
    out = periodic_runs.periodic_runs(docs)
    assert set(out.columns) == {*docs.columns, "collapsed"}
    by = {r["doc_id"]: r for r in out.where("doc_id in (0, 4)").collect()}
    assert by[0]["runs"] == [] and by[0]["collapsed"] == "" and by[0]["hits"] == 1
    assert [tuple(x) for x in by[4]["runs"]] == [(0, 40, 1)] and by[4]["collapsed"] == "go"
    assert periodic_runs.run_report(docs.limit(0)).count() == 0
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0


def test_a_long_document_of_one_word_and_of_one_long_period():
    one = np.zeros(300_000, np.int64)
    base = np.arange(70_000)
    words = np.concatenate([one, base, base, base[:5]])
    row, start, length, period = periodic_runs.find_runs(words, np.array([len(one), 2 * len(base) + 5]))
    assert list(zip(row.tolist(), start.tolist(), length.tolist(), period.tolist())) == [(0, 0, 300_000, 1), (1, 0, 140_005, 70_000)]


LOWER = {i: i + 32 for i in range(65, 91)}
LONG = " ".join(f"q{i}" for i in range(45))
ITEMS = [(1, LONG), (2, "One two, THREE"), (3, ""), (4, None), (None, " ".join(f"é{i}" for i in range(12))), (10, " ".join(f"q{i}" for i in range(5, 20))), (10, "other words of the same item in a second row here yes"), (20, "Two"), (20, "Two")]
DOCS = [
    None, "", "...!!!", LONG, "zz " + LONG.upper().replace(" ", " -- ") + " zz", " ".join(LONG.split()[3:13]), " ".join(LONG.split()[3:12]), "one two", "x One\tTwo;three y one two three",
    "日本 " + " ".join(f"É{i}" for i in range(12)), "日本 " + " ".join(f"é{i}" for i in range(12)) + " fin", (LONG + " . ") * 50, "other words of the same item in a second row here yes", "a_two", "two\x00two",
]


def brute_hits(text, items):
    w = NORMAL.findall((text or "").translate(LOWER))
    hit, held = set(), set()
    for item, t in items:
        x = NORMAL.findall((t or "").translate(LOWER))
        n = min(10, len(x))
        for i in range(len(x) - n + 1 if x else 0):
            for j in range(len(w) - n + 1):
                if w[j : j + n] == x[i : i + n]:
                    hit |= set(range(j, j + n))
                    held.add("" if item is None else str(item))
    return len(w), len(hit), len(held), hashlib.sha256(",".join(sorted(held)).encode()).hexdigest(), bool(hit)


@pytest.fixture(scope="module")
def passage_docs(spark):
    rows = [(k * 3, t, "l", "r", 1, "") for k, t in enumerate(DOCS)] + [(None, LONG, None, None, None, None), (0, LONG, "l", "r", 1, ""), (0, LONG, "l", "r", 1, "")]
    return rows, spark.createDataFrame(rows, f"doc_id long, text string, {EXTRA}").repartition(3)


@pytest.mark.parametrize("shard_bytes", [1 << 21, 40])
def test_passages_equal_brute_force(spark, passage_docs, shard_bytes, monkeypatch):
    rows, docs = passage_docs
    if shard_bytes < 100:
        monkeypatch.setattr(decontaminate, "SEGMENT_WORDS", 7)
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, hits string")
    out = decontaminate.find_passages(docs, items, shard_bytes=shard_bytes)
    got = []
    for r in out.collect():
        n_hit = sum(h["last"] - h["first"] for h in r["hits"])
        got.append((r["doc_id"], r["n_words"], n_hit, len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r["contaminated"]))
        for h in r["hits"]:
            cut = NORMAL.findall(r["text"][h["start"] : h["end"]].translate(LOWER))
            assert cut == NORMAL.findall(r["text"].translate(LOWER))[h["first"] : h["last"]]
    assert sorted(got, key=repr) == sorted(((r[0], *brute_hits(r[1], ITEMS)) for r in rows), key=repr)


def test_report_and_filter(spark, passage_docs):
    rows, docs = passage_docs
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    report = decontaminate.contamination_report(docs, items)
    assert sorted((tuple(r) for r in report.collect()), key=repr) == sorted(((r[0], *brute_hits(r[1], ITEMS)) for r in rows), key=repr)
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted((r for r in rows if not brute_hits(r[1], ITEMS)[-1]), key=repr)
    assert decontaminate.contamination_report(docs.limit(0), items).count() == 0
    for none in (items.limit(0), items.where("item_id = 4")):
        got = decontaminate.contamination_report(docs, none).collect()
        assert sorted((r["doc_id"] or 0, r["n_words"]) for r in got) == sorted((r[0] or 0, brute_hits(r[1], [])[0]) for r in rows)
        assert not any(r["contaminated"] or r["n_hit"] or r["n_items"] for r in got)
