import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from reelmill.llm import exact_dedup, line_dedup, near_dedup, substring_dedup
from tests.llm.helpers import AWKWARD, corpus, lower, table, words_of

ROWS = corpus() + AWKWARD


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, ROWS).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, ROWS).limit(0)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def exact_rows(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t)].append(i)
    return sorted((i, max(groups[lower(t)]), len(groups[lower(t)]), i == max(groups[lower(t)]), sha(lower(t))) for i, t in rows)


@pytest.mark.parametrize("broadcast", [10**6, 600, 0])
def test_exact_dedup_is_brute_force(docs, broadcast):
    assert sorted(map(tuple, exact_dedup.exact_dedup(docs, broadcast_bytes=broadcast).collect())) == exact_rows(ROWS)


def test_exact_dedup_whole_rows_empty_and_null_ids(spark, docs, empty):
    kept = exact_dedup.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r[0] for r in exact_rows(ROWS) if r[3])
    assert exact_dedup.exact_dedup(empty).count() == 0
    got = exact_dedup.exact_dedup(table(spark, [(None, "a"), (5, "A"), (None, "b")])).collect()
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["kept"]) for r in got) == [("5", "5", True), ("None", "5", False), ("None", "None", True)]
    kept = exact_dedup.deduplicated(table(spark, [(None, "a"), (5, "A"), (None, "b"), (6, "c"), (6, "a")])).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept) == [("6", "a"), ("6", "c"), ("None", "b")]


def substring_rows(rows, window):
    first = {}
    for i, t in rows:
        w = words_of(t)
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = words_of(t)
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out)


@pytest.mark.parametrize(("window", "broadcast"), [(50, 10**6), (50, 0), (6, 10**6)])
def test_substring_dedup_is_brute_force(docs, window, broadcast):
    want = substring_rows(ROWS, window)
    assert any(r[2] for r in want)
    assert sorted(map(tuple, substring_dedup.substring_dedup(docs, window=window, broadcast_bytes=broadcast).collect())) == want


def test_substring_dedup_branches_at_shared_words(spark):
    rng = random.Random(5)
    base = [f"b{k}" for k in range(120)]
    rows = []
    for i in range(12):  # copies that differ in single words, so that paths branch and meet again
        w = list(base)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(6)}"
        rows.append((i, " ".join(w[rng.randrange(20) :])))
    got = substring_dedup.substring_dedup(table(spark, rows), window=20).collect()
    assert sorted(map(tuple, got)) == substring_rows(rows, 20)


def test_substring_dedup_empty(empty):
    assert substring_dedup.substring_dedup(empty).count() == 0


def line_rows(rows, lines, chars):
    runs = []
    texts = {}
    for at, (i, t) in enumerate(rows):
        ls = t.split("\n") if t else []
        texts[at] = ls
        own = []
        for k in range(len(ls)):
            n = next((n for n in range(1, lines) if k + n <= len(ls) and sum(map(len, ls[k : k + n])) >= chars), lines)
            if k + n <= len(ls):
                own.append((k, n))
        for k, n in own or ([(0, len(ls))] if ls else []):
            runs.append((tuple(ls[k : k + n]), i, k, n, at))
    first = {}
    for run, i, k, _, _ in runs:
        first[run] = min(first.get(run, (i, k)), (i, k))
    gone = defaultdict(set)
    for run, i, k, n, at in runs:
        if (i, k) > first[run]:
            gone[at].update(range(k, k + n))
    return sorted((i, len(texts[at]), len(gone[at]), "\n".join(x for k, x in enumerate(texts[at]) if k not in gone[at])) for at, (i, t) in enumerate(rows))


#: Repeats of one long line, of short lines in a row, inside one text, between different neighbours, and a text of one line very often.
LINED = [
    (2000, "a\nb\nc\nd\ne\nf"), (2001, "x\nb\nc\nd\ne\ny"), (2002, "z\n" + "long line " * 9 + "\nz2"), (2003, "q\n" + "long line " * 9 + "\nq2"), (2004, "a\nb\nc\nd\nother\na\nb\nc\nd"),
    (2005, "b\nc"), (2006, "b\nc"), (2007, "\n\n\n\n\n"), (2008, "again\n" * 20_000), (2009, "\n" + "twenty characters..." + "\n" + "twenty characters..." + "\nend"), (2010, "twenty characters...\ntwenty characters..."),
]


@pytest.mark.parametrize(("lines", "chars", "broadcast"), [(4, 40, 10**6), (4, 40, 0), (2, 10**6, 10**6), (1, 10**6, 10**6)])
def test_line_dedup_is_brute_force(spark, lines, chars, broadcast):
    want = line_rows(ROWS + LINED, lines, chars)
    assert any(r[2] for r in want)
    assert sorted(map(tuple, line_dedup.line_dedup(table(spark, ROWS + LINED), lines=lines, chars=chars, broadcast_bytes=broadcast).collect())) == want


def test_line_dedup_keeps_only_minima(spark):
    rng = random.Random(8)
    keyed = line_dedup._keyed(table(spark, [(k, "\n".join(f"l{rng.randrange(10**9)}" for _ in range(400))) for k in range(5)]), "doc_id", "text")
    windowed = line_dedup._windowed(line_dedup._hashed(keyed), 4, 10**6, False).select(F.size("_w").alias("n"), F.size(line_dedup._minima()).alias("m")).collect()
    assert all(r["n"] == 397 and r["m"] < 0.5 * r["n"] for r in windowed)  # two of five lines are expected


def test_line_dedup_whole_rows(docs, empty):
    kept = line_dedup.deduplicated(docs)
    assert kept.columns == docs.columns
    got = {r["doc_id"]: r for r in kept.collect()}
    texts = dict(ROWS)
    for i, n, gone, text in line_rows(ROWS, 4, 40):
        if n and gone == n:
            assert i not in got
        else:
            assert got[i]["text"] == (text if gone else texts[i])
            assert got[i]["n_chars"] == len(got[i]["text"] or "") and got[i]["_text"] == "x"
    assert line_dedup.line_dedup(empty).count() == 0


def near_rows(rows, k, percent):
    sets = []
    for i, t in rows:
        w = words_of(lower(t))
        sets.append({tuple(w[x : x + k]) for x in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                group[find(a)] = find(b)
    least = defaultdict(lambda: 10**9)
    for x, (i, _) in enumerate(rows):
        least[find(x)] = min(least[find(x)], i)
    return sorted((i, len(sets[x]), least[find(x)], i == least[find(x)]) for x, (i, _) in enumerate(rows))


@pytest.mark.parametrize(("k", "percent", "broadcast"), [(3, 85, 10**6), (5, 80, 0)])
def test_near_dedup_is_brute_force(docs, k, percent, broadcast):
    want = near_rows(ROWS, k, percent)
    assert sum(not r[3] for r in want) > 5
    assert sorted(map(tuple, near_dedup.near_dedup(docs, k=k, percent=percent, broadcast_bytes=broadcast).collect())) == want


def test_near_dedup_of_a_large_group_with_small_tiles(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "TILE_CLASSES", 4)
    monkeypatch.setattr(near_dedup, "VISITOR_SHINGLES", 500)
    rng = random.Random(3)
    base = [f"b{k}" for k in range(80)]
    rows = []
    for i in range(70):
        w = list(base)
        for _ in range(rng.randrange(6)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(30)}"
        rows.append((i, " ".join(w)))
    assert sorted(map(tuple, near_dedup.near_dedup(table(spark, rows), k=3, percent=85).collect())) == near_rows(rows, 3, 85)


def test_near_dedup_of_texts_under_one_id(spark):
    rows = [(1, "a b c d e f g"), (5, "a b c d e f g"), (5, "other words than those above here"), (None, "other words than those above here")]
    got = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_dedup.near_dedup(table(spark, rows)).collect()}
    assert got == {(1, 3, 1, True), (5, 3, 1, False), (5, 2, None, False), (None, 2, None, True)}
    kept = near_dedup.deduplicated(table(spark, rows[:2] + [(5, "words of nobody else in here")])).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == [(1, rows[0][1]), (5, "words of nobody else in here")]


def test_near_dedup_of_chains_and_stragglers(spark, monkeypatch):
    """Texts that share keys with a group but are linked to few of it, or to none."""
    monkeypatch.setattr(near_dedup, "TILE_CLASSES", 3)
    monkeypatch.setattr(near_dedup, "VISITOR_SHINGLES", 300)
    rng = random.Random(13)
    w = [f"b{k}" for k in range(90)]
    rows = []
    for i in range(60):
        rows.append((i, " ".join(w)))
        for _ in range(rng.choice([1, 2, 5, 9])):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
    rng.shuffle(rows)
    want = near_rows(rows, 3, 85)
    assert 5 < len({r[2] for r in want}) < 55
    assert sorted(map(tuple, near_dedup.near_dedup(table(spark, rows), k=3, percent=85).collect())) == want


def test_near_dedup_whole_rows_and_empty(docs, empty):
    kept = near_dedup.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r[0] for r in near_rows(ROWS, 5, 80) if r[3])
    assert near_dedup.near_dedup(empty).count() == 0
