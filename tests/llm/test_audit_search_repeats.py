"""Filter audit, ranked search and repeated passages against plain Python and SQL, on odd rows, and on none."""

import itertools
import math
import re
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest

from quayside.llm import filter_audit, lexical_search, queries, suffix_dedup


def tuples(frame, *columns):
    return sorted((tuple(r) for r in (frame.select(*columns) if columns else frame).collect()), key=repr)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(name, spark, sf_dir, oracle):
    frame = queries.QUERIES[name](spark, sf_dir)
    expected = oracle.sql(queries.ORACLES[name])
    assert sorted(frame.columns) == sorted(expected.columns)
    assert tuples(frame, *expected.columns) == sorted(expected.fetchall(), key=repr)


# Filter audit.


def fails_of(docs):
    """Letters of the filters that each (doc_id, text) fails."""
    out = []
    for i, t in docs:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        out.append({
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t), "D": any(c in "#$%&*|" for c in t),
            "E": i is not None and any(j is not None and j < i and (u or "") == t for j, u in docs),
        })
    return out


def audit_of(docs, langs, labels):
    fails, out = fails_of(docs), []
    for part in sorted({x or "" for x in langs}):
        own = [k for k, x in enumerate(langs) if (x or "") == part]
        steps = []
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, name in enumerate(order):
                removed = [k for k in left if fails[k][name]]
                left = [k for k in left if not fails[k][name]]
                every = [k for k in own if fails[k][name]]
                good, toxic = (sum(labels.get(docs[k][0], (0, 0))[n] == 1 for k in removed) for n in (0, 1))
                unique = sum(sum(fails[k].values()) == 1 for k in every)
                steps.append([part, order, step + 1, len(left), len(removed), len(every) - len(removed), unique, good, toxic])
        total = Counter()
        for row in steps:
            total[row[1][row[2] - 1]] += row[4]
        out += [(*row, total[row[1][row[2] - 1]]) for row in steps]
    return sorted(out, key=repr)


def test_audit_of_odd_rows(spark, table_of, odd):
    text = " ".join(f"w{k}" for k in range(300))
    docs = [*odd, (20, text), (21, text), (21, text), (None, text), (22, text + " A*B"), (23, text), (24, ""), (None, None)]
    langs = [None if k % 5 == 0 else ["de", "en", ""][k % 3] for k in range(len(docs))]
    rows = [(i, t, lang, "mine", "mine", "mine") for (i, t), lang in zip(docs, langs)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, part string, fails string, good string")
    labels = {1: (1, 0), 20: (1, 1), 21: (1, 0), 23: (0, 1), 4: (None, None)}
    given = [(i, q, x) for i, (q, x) in labels.items()] + [(20, 0, None), (None, 1, 1), (999, 1, 1)]
    table = spark.createDataFrame(given, "doc_id long, quality int, toxic int")
    assert tuples(filter_audit.audit(frame, table)) == audit_of(docs, langs, labels)
    assert filter_audit.audit(frame.limit(0), table).count() == 0
    assert filter_audit.audit(frame, table.limit(0)).agg({"good_lost": "sum"}).first()[0] == 0


# Ranked search.


def ranked_of(docs, items, top=10):
    def terms(text):
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lower)

    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    total, length = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in counted:
            m = 25 + 75 * sum(c.values()) * total // length
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text)
            )
            if score > 0:
                scores.append((-score, i is None, i, score))
        out += [(item, k + 1, i, score) for k, (_, _, i, score) in enumerate(sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:top])]
    return sorted(out, key=repr)


def test_search_of_odd_rows_in_small_trees_and_blocks(spark, table_of, odd):
    rng = np.random.default_rng(3)
    words = [f"t{k}" for k in range(60)]
    texts = [" ".join(rng.choice(words, int(n))) for n in rng.integers(1, 40, 300)]
    docs = [*odd, *((100 + k, t) for k, t in enumerate(texts)), (100, texts[0]), (50, texts[1]), (None, texts[2]), (51, "T1, t1; Übung t1")]
    items = [(k, " ".join(rng.choice(words, 8))) for k in range(25)]
    items += [(30, None), (31, ""), (32, "no such term"), (33, "T1 t1 ÜBUNG Übung"), (34, odd[6][1][:2000]), (5, "naïve 日本語")]
    asked = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, score string")
    for plan in (lexical_search.Search(), lexical_search.Search(items=4, tree=32, leaf=2), lexical_search.Search(top=3, terms=9, tree=50, leaf=5)):
        found = lexical_search.ranked_documents(table_of(docs), asked, plan)
        assert tuples(found, "item_id", "rank", "doc_id", "score") == ranked_of(docs, items, plan.top)
    assert lexical_search.ranked_documents(table_of([]), asked).count() == 0
    assert lexical_search.ranked_documents(table_of(docs), asked.limit(0)).count() == 0


def test_bounds_hold_for_all_rows_of_a_node():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 30, 400)
    start = np.concatenate([[0], np.cumsum(sizes)])
    cols = np.concatenate([rng.choice(80, s, replace=False) for s in sizes])
    vals = rng.integers(1, 1_000_000, len(cols))
    block = [(k, Counter(f"w{c}".encode() for c in rng.integers(0, 80, 12))) for k in range(20)]
    asked = lexical_search.queries_of(block)
    weight = rng.integers(0, 12_000, len(asked.vocabulary))
    known = cols < len(weight)
    start = np.concatenate([[0], np.cumsum(np.add.reduceat(known, start[:-1]))])
    full = np.flatnonzero(np.diff(start))
    start = np.concatenate([[0], np.cumsum(np.diff(start)[full])])
    tree = lexical_search.BallTree(start, cols[known], vals[known], asked, weight, 8)
    exact = np.zeros((20, len(start) - 1), np.int64)
    for node, rows in enumerate(tree.members):
        if tree.children[node] is None:
            exact[:, rows] = tree.leaf_scores(node)
    assert all((tree.bounds[n][:, None] >= exact[:, rows]).all() for n, rows in enumerate(tree.members))


def test_trees_leave_documents_out(spark):
    """Far groups of documents are not scored for items of another group."""
    rows = [(k, " ".join(f"g{k // 64}x{j}" for j in range(20))) for k in range(1024)]
    asked = lexical_search.queries_of([(0, Counter({f"g3x{j}".encode(): 1 for j in range(20)}))])
    cols, start = [], [0]
    vocabulary = {t: n for n, t in enumerate(sorted({w for _, t in rows for w in t.split()}))}
    cols = np.array([vocabulary[w] for _, t in rows for w in t.split()])
    start = np.arange(0, len(cols) + 1, 20)
    term = np.array([vocabulary[t.decode()] for t in asked.vocabulary])
    order = np.argsort(term)
    sizes = np.zeros(len(vocabulary) + 1, np.int64)
    sizes[term + 1] = 1
    own = lexical_search.Queries([0], vocabulary, np.cumsum(sizes), asked.item[order], asked.times[order])
    tree = lexical_search.BallTree(start, cols, np.full(len(cols), 500_000), own, np.full(len(vocabulary), 3000), 8)
    best = lexical_search.Best(10)
    visits, scored = tree.search(0, best.least), 0
    step = next(visits, None)
    while step is not None:
        scored += len(step[0])
        best.add(step[1], step[0].tolist())
        try:
            step = visits.send(best.least)
        except StopIteration:
            step = None
    assert [row[2] for row in best.rows] == list(range(192, 202)) and scored < 200


# Repeated passages.


@pytest.mark.parametrize("plan", [
    suffix_dedup.Repeats(), suffix_dedup.Repeats(block=100_000, lanes=16, fan=3), suffix_dedup.Repeats(block=150_000, surroundings=1, blocks=2),
])
def test_repeats_of_the_documents(spark, sf_dir, given, plan):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert tuples(suffix_dedup.repeated_bytes(docs, plan)) == sorted(brute.repeats(given), key=repr)


def passages():
    rng = np.random.default_rng(8)
    word = lambda n: " ".join(f"{x:x}" for x in rng.integers(0, 1 << 40, n))
    shared, other = word(12), word(5)[:50]
    docs = [(k, f"{word(k % 7)} {shared[k % 11 : 140 - k % 13]} {word(k % 5)}") for k in range(60)]
    docs += [(100 + k, "ab" * 200 + word(3)) for k in range(4)] + [(110, "a" * 500), (111, "a" * 49), (112, "a" * 50), (113, "a" * 51)]
    docs += [(120, other), (121, f"x{other}"), (122, other[:49]), (123, f"{other}{other}"), (124, "\0" * 120 + other), (125, "\0" * 90)]
    docs += [(130, "ü日👍🏽" * 40), (131, "日👍🏽ü" * 30), (120, f"{other} again {other}"), (110, "a" * 500)]
    return docs


def test_repeats_of_odd_rows(table_of, odd):
    docs = [*odd, *passages()]
    expected = sorted(brute.repeats(docs), key=repr)
    for plan in (suffix_dedup.Repeats(), suffix_dedup.Repeats(block=60_000, fan=2), suffix_dedup.Repeats(block=100_000, surroundings=2, blocks=3, lanes=3)):
        assert tuples(suffix_dedup.repeated_bytes(table_of(docs), plan)) == expected
    found = suffix_dedup.repeated_bytes(table_of([(None, "b" * 80), (None, "b" * 80), (7, "b" * 80), (8, None)]))
    assert sorted(r[2] for r in found.collect()) == [0, 0, 0, 0]
    assert suffix_dedup.repeated_bytes(table_of([])).count() == 0


def test_documents_without_repeats(table_of):
    docs = [*passages(), (None, "c" * 60), (300, None), (301, "")]
    cut = suffix_dedup.without_repeats(table_of(docs))
    assert cut.columns == table_of([]).columns and cut.where("score = 'mine'").count() == len(docs)
    found, lengths = defaultdict(list), defaultdict(list)
    for row in cut.collect():
        found[row.doc_id].append(row.text)
    for i, n, removed, _, _ in brute.repeats(docs):
        lengths[i].append(n - removed)
    assert found[300] == [None] and found[301] == [""] and found[None] == ["c" * 60] and found[125] == [""]
    # Cuts within a character lose the rest of it.
    assert all(len((t or "").encode()) <= n for i in found for t, n in zip(sorted(found[i], key=lambda t: len(t or "")), sorted(lengths[i])))
    plain = [i for i in found if i not in (130, 131)]
    assert all(sorted(len((t or "").encode()) for t in found[i]) == sorted(lengths[i]) for i in plain)


def test_runs_are_coded_and_merged_as_sorted():
    rng = np.random.default_rng(2)
    plan = suffix_dedup.Repeats()
    rows = rng.integers(0, 3, (900, 50)).astype(np.uint8)
    rows[:, :8] = 1
    rows[::3] = rows[0]
    runs = []
    for k, part in enumerate(np.array_split(np.arange(900), 7)):
        right = rows[part]
        right = right[suffix_dedup._order(suffix_dedup._words(right))]
        n = len(right)
        zero = np.zeros(n, np.int64)
        own = suffix_dedup.Suffixes(right, np.full((n, 30), 7, np.uint8), zero, zero + 30, part, zero + k, zero, part)
        coded = suffix_dedup.front_coded(own, plan)
        assert len(coded["right"]) < right.size
        back, common = suffix_dedup.decoded(coded | {"block": k}, plan)
        assert (back.right == right).all() and (back.doc == part).all() and (back.left == 7).all()
        assert (common[1:] == suffix_dedup._common(right[1:], right[:-1])).all()
        runs.append(coded | {"block": k})
    for fan, lanes in ((64, 4096), (2, 1), (3, 5)):
        merged, common = suffix_dedup._merged(runs, suffix_dedup.Repeats(fan=fan, lanes=lanes))
        assert (merged.right == rows[suffix_dedup._order(suffix_dedup._words(rows))]).all()
        assert (common[1:] == suffix_dedup._common(merged.right[1:], merged.right[:-1])).all()


def test_hashes_of_anchors_fill_all_parts_alike():
    plan = suffix_dedup.Repeats()
    text = np.random.default_rng(3).integers(0, 256, 300_000).astype(np.uint8)
    ends = np.array([100_000, 300_000])
    block = suffix_dedup.Block(text, ends, np.arange(2), np.arange(2))
    hashes = suffix_dedup._announced(block, suffix_dedup.find_anchors(text, ends, plan), plan)
    for parts in (4, 64):
        sizes = np.bincount(suffix_dedup._parts_of(hashes, parts), minlength=parts)
        assert len(hashes) > 15_000 and sizes.max() < 1.5 * sizes.mean() and sizes.min() > 0.5 * sizes.mean()
