"""Every operator against plain Python over all rows: on the given tables, on odd rows, and on none."""

import collections
import math
import zlib

import brute
import numpy as np
import pytest

from quayside.llm import (
    byte_bpe, components, line_dedup, line_rules, near_dedup, packing, private_data, quality_model, queries, sharding,
    token_files, vector_dedup,
)


def tuples(frame, *columns):
    return sorted(tuple(r) for r in (frame.select(*columns) if columns else frame).collect())


def near(frame, plan):
    return tuples(near_dedup.near_duplicates(frame, plan), "doc_id", "n_shingles", "component_id", "kept")


def test_near_duplicates_of_the_documents(spark, sf_dir, given):
    assert tuples(queries.op1_minhash_near_dedup(spark, sf_dir)) == brute.near_duplicates(given, 4)


def test_near_duplicates_of_odd_rows(table_of, odd):
    assert near(table_of(odd), near_dedup.MinHash(shingle=4)) == brute.near_duplicates(odd, 4)


def test_near_duplicates_of_chains_and_groups_that_do_not_link(table_of):
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in range(120)]
    docs = []
    for n in range(60):
        words = list(base)
        for k in rng.integers(0, len(base), 1 + n % 7):
            words[k] = f"x{n}_{k}"
        docs.append((n, " ".join(words)))
    plan = near_dedup.MinHash(shingle=4, tile=7)
    expected = brute.near_duplicates(docs, 4)
    assert len({c for _, _, c, _ in expected}) > 3
    assert near(table_of(docs), plan) == expected


def test_near_duplicates_of_null_ids_and_no_rows(table_of):
    found = near_dedup.near_duplicates(table_of([(None, "a b c d e"), (3, "a b c d e"), (4, "a b c d e")])).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in found} == {(None, None, False), (3, 3, True), (4, 3, False)}
    assert near_dedup.near_duplicates(table_of([])).count() == 0


def test_near_duplicates_of_a_doc_id_with_different_texts(table_of):
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    near_b = b + " more"
    # 1 has the texts a and b; 3 is near to its b, 2 equals its a; 7 and 8 are alike in c; 9 joins them by id.
    docs = [(1, a), (1, b), (2, a), (3, near_b), (7, c), (8, c + " x"), (9, c + " y"), (9, "else " + a[:40]), (0, "no link at all")]
    found = {(r.doc_id, r.component_id, r.kept) for r in near_dedup.near_duplicates(table_of(docs)).collect()}
    assert found == {(0, 0, True), (1, 1, True), (2, 1, False), (3, 1, False), (7, 7, True), (8, 7, False), (9, 7, False)}


def test_deduplicated_keeps_columns_and_one_of_each(table_of, odd):
    docs = table_of(odd)
    kept = near_dedup.deduplicated(docs)
    assert kept.columns == docs.columns
    expected = [i for i, _, _, own in brute.near_duplicates(odd, 5) if own]
    assert sorted(r.doc_id for r in kept.collect()) == expected


def test_common_shingles_counts_in_pieces():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 300, 200).astype(np.uint64)) for _ in range(9)]
    found = near_dedup.common_shingles(sets, np.arange(5), np.arange(9), columns=16)
    for i in range(5):
        for j in range(9):
            assert i == j or found[i, j] == len(np.intersect1d(sets[i], sets[j]))


def test_components_of_random_graphs(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(k, k + 1) for k in range(1000, 1040)]
    found = components.components(spark.createDataFrame(edges, "u long, v long"))
    every = brute.components({x for e in edges for x in e}, edges)
    linked = {x for e in edges if e[0] != e[1] for x in e}
    assert dict(tuples(found)) == {i: every[i] for i in linked}


def test_shards_of_the_documents(spark, sf_dir, given):
    rows = queries.op2_rendezvous_sharding(spark, sf_dir).collect()
    texts = dict(given)
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert r.grown_shard in (r.shard, 16)
    for shard in range(16):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))


def test_shards_follow_weights_and_odd_rows_have_places(spark, table_of, odd):
    from pyspark.sql import functions as F

    placed = spark.range(40_000).select(sharding.rendezvous(F.col("id"), [(0, 1.0), (1, 2.0), (2, 1.0)]).alias("s"))
    counts = dict(tuples(placed.groupBy("s").count()))
    assert abs(counts[1] - 20_000) < 600 and abs(counts[0] - 10_000) < 600
    rows = sharding.shard_documents(table_of([*odd, (None, "a"), (None, None), (4, "one two")])).collect()
    assert len(rows) == len(odd) + 3
    assert len({r.shard for r in rows if r.doc_id is None}) == len({r.shard for r in rows if r.doc_id == 4}) == 1
    assert sharding.shard_documents(table_of([])).count() == 0
    with pytest.raises(ValueError):
        sharding.rendezvous(F.col("id"), [(0, 0.0)])


def test_numbering_over_many_blocks(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(sharding, "BLOCK", 7)
    rows = spark.range(0, 1000, 1, 5).select((F.col("id") % 3).alias("g"))
    numbered = sharding.numbered(rows, "g", "n").collect()
    for g in range(3):
        assert sorted(r.n for r in numbered if r.g == g) == list(range(sum(r.g == g for r in numbered)))


def test_line_dedup(spark, sf_dir, given, table_of, odd):
    assert tuples(queries.op3_line_dedup(spark, sf_dir)) == brute.line_dedup(given)
    from pyspark.sql import functions as F

    cleaned = line_dedup.dedup_lines(table_of(odd))
    digest = F.sha2(F.col("text").cast("binary"), 256)
    assert tuples(cleaned, "doc_id", "n_lines", "n_dropped", digest) == brute.line_dedup(odd)
    assert {c for c in table_of(odd).columns if c != "n_lines"} <= set(cleaned.columns)
    again = line_dedup.dedup_lines(table_of([*odd, odd[9], (None, odd[9][1])])).collect()
    assert [r.n_dropped for r in again if r.doc_id == 10] == [1, 1]
    assert [r.n_dropped for r in again if r.doc_id is None] == [0]
    assert line_dedup.dedup_lines(table_of([])).count() == 0


def test_line_dedup_deals_rows_without_an_id_to_all_tasks(spark):
    from pyspark.sql import functions as F

    line = "a line that all of the documents share"
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).alias("doc_id"), F.concat(F.lit(f"{line}\n"), "id").alias("text"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = line_dedup.dedup_lines(rows).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(found) == 3000
    assert {(r.doc_id, r.n_dropped) for r in found if r.doc_id is not None} == {(i, int(i != 2997)) for i in range(0, 3000, 3)}
    assert [r.n_dropped for r in found if r.doc_id is None] == [0] * 2000
    tasks = [r.task for r in found if r.doc_id is None]
    assert max(map(tasks.count, set(tasks))) < 1000


def test_byte_bpe(spark, sf_dir, given, table_of, odd):
    assert tuples(queries.op4_byte_bpe(spark, sf_dir)) == brute.byte_bpe(given, queries.BYTE_BPE)
    odd = [*odd, (20, "ab" * 400), (21, "\x1c  x\u0085 \U00010ee7a 'S's  \n "), (None, "x")]
    import public_tokenizers

    digests = byte_bpe.digest_documents(table_of(odd), queries.BYTE_BPE, public_tokenizers.PATTERN)
    assert sorted(map(repr, digests.collect())) == sorted(
        f"Row(doc_id={i}, n_tokens={n}, ids_sha256='{a}', decoded_sha256='{b}')"
        for d in odd for i, n, a, b in brute.byte_bpe([d], queries.BYTE_BPE)
    )
    encoded = byte_bpe.encode_documents(table_of(odd), queries.BYTE_BPE, public_tokenizers.PATTERN)
    decoded = byte_bpe.decode_documents(encoded, queries.BYTE_BPE).collect()
    assert all(bytes(r.decoded) == (r.text or "").encode() and r["rest"] == "mine" for r in decoded)
    assert byte_bpe.encode_documents(table_of([]), queries.BYTE_BPE, public_tokenizers.PATTERN).count() == 0


def test_texts_with_the_newest_characters_go_through_the_merges(monkeypatch):
    import unicodedata

    import public_tokenizers
    import regex
    import tiktoken

    path, pattern = queries.BYTE_BPE, public_tokenizers.PATTERN
    newest = [chr(c) for c in range(0x80, 0x110000) if unicodedata.category(chr(c)) == "Cn"]
    letters = [c for c in newest if regex.match(r"\p{L}", c)]
    texts = [f"ab{c}cd {c}{c}x {c}1{c}" for c in [*letters[::97], *newest[::9973]]] + ["".join(letters[::31])]
    library = tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks=byte_bpe.replay_of(path).ranks, special_tokens={})
    expected = [library.encode_ordinary(text) for text in texts]
    encode, words = byte_bpe.MergeReplay.encode, set()
    monkeypatch.setattr(byte_bpe.MergeReplay, "encode", lambda self, new: (words.update(new), encode(self, new))[1])
    monkeypatch.setattr(tiktoken.Encoding, "encode_ordinary", lambda self, text: self._core_bpe.encode_ordinary(text) if self.name == "class" else None)
    byte_bpe._known.cache_clear()
    assert list(byte_bpe.encode_texts(texts, path, pattern)) == expected
    assert any(len(w.decode()) == 1 and w.decode() in letters for w in words)


def test_merges_that_make_pairs_of_lower_rank_stay_exact():
    import tiktoken

    ranks = {bytes([b]): b for b in range(256)} | {b"xa": 256, b"ab": 258, b"abxa": 259, b"aba": 257, b"aa": 260, b"abab": 261}
    merges, library = byte_bpe.MergeReplay(ranks), tiktoken.Encoding("t", pat_str=r".+", mergeable_ranks=ranks, special_tokens={})
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abx"), n)) for n in rng.integers(1, 25, 400)]
    assert merges.encode([w.encode() for w in words]) == [library.encode_ordinary(w) for w in words]


def test_token_files(spark, sf_dir, given, table_of, odd):
    assert tuples(queries.op5_token_files(spark, sf_dir)) == brute.token_files(given, queries.WORD_BPE)
    docs = table_of([*odd, (4, "again"), (None, "x"), (None, None)])
    files = token_files.write_token_files(docs, queries.WORD_BPE)
    keys = token_files.written_keys(spark, files)
    found = token_files.read_by_key(spark, files, keys).orderBy("start").collect()
    assert [r.doc_id for r in found] == sorted((i for i, _ in [*odd, (4, ""), (None, ""), (None, "")]), key=lambda i: (i is not None, i))
    assert [r.start for r in found] == [sum(r.n for r in found[:k]) for k in range(len(found))]
    by_id = {i: ids for (i, _), ids in zip(odd, brute.word_ids([t for _, t in odd], queries.WORD_BPE))}
    for r in found:
        if r.doc_id not in (None, 4):
            assert np.frombuffer(r.ids, "<u4").tolist() == [*by_id[r.doc_id], 1]
    absent = spark.createDataFrame([(10**6 + k, 0) for k in range(50)], "doc_id long, copy long")
    assert token_files.read_by_key(spark, files, absent).count() == 0
    assert token_files.read_by_key(spark, token_files.write_token_files(table_of([]), queries.WORD_BPE), absent).count() == 0


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(4)
    high, low = rng.integers(0, 1 << 63, (2, 5000)).astype(np.uint64)
    function, _ = token_files.PerfectHash.from_bytes(token_files.PerfectHash.build(high, low).to_bytes())
    assert sorted(function.slots(high, low).tolist()) == list(range(5000))
    with pytest.raises(ValueError):
        token_files.PerfectHash.build(high[[1, 1]], low[[1, 1]])


def spans(row):
    return [f"{s.kind}:{s.start}:{s.end}" for s in row.spans]


def test_private_data(spark, sf_dir, given, table_of, odd):
    more = [(30, "1.2.3.4.5.6.7.8 300.1.1.1 01.002.3.4"), (31, "+1 (2) 3-4.5 +123456789012345678 ++49 30 1234567"),
            (32, "4111-1111-1111-1111 4111 1111 1111 1112 1234"), (33, "a@b a@b.c.d@e.f %@x.y. a@-.-"), (34, "é 10.0.0.1")]
    for docs, frame in ((given, queries.documents(spark, sf_dir)), (odd + more, table_of(odd + more))):
        found = {r.doc_id: spans(r) for r in private_data.all_spans(frame).collect()}
        for i, text in docs:
            base = [s for s in found[i] if s.split(":")[0] in private_data.BASE_KINDS]
            assert base == [f"{k}:{a}:{b}" for k, a, b in brute.base_spans(text)], text
    assert private_data.all_spans(table_of([])).count() == 0


def test_terms_that_give_an_entity_away_are_removed(table_of):
    docs = [(k, f"the and of call the zanzibari envoy at envoy@example.org the and of number {k}") for k in range(6)]
    docs += [(100 + k, "the and of call at number the common words of all texts") for k in range(300)]
    found = {r.doc_id: r for r in private_data.all_spans(table_of([*docs, docs[0], (None, docs[0][1])])).collect()}
    terms = {docs[3][1][int(a):int(b)] for kind, a, b in (s.split(":") for s in spans(found[3])) if kind != "email"}
    assert terms == {"zanzibari", "envoy"}
    assert spans(found[101]) == [] and [s.split(":")[0] for s in spans(found[None])] == ["email"]
    clean = private_data.sanitise(table_of([*docs, (7000, None), (7001, "")]))
    assert clean.columns == table_of([]).columns
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[3] == "the and of call the   at [EMAIL] the and of number 3"
    assert texts[101] == docs[7][1] and texts[7000] is None and texts[7001] == ""


def test_a_document_or_copies_of_it_reveal_nothing(table_of):
    """However rare an entity is: what stands beside it once, or in copies, is no evidence, at no size of the corpus."""
    for n in (300, 3000):
        docs = [(1, "the common zanzibari at envoy@example.org the words"), *[(10 + k, "a bohemian at +1 (017) 555-7713 here") for k in range(30)]]
        docs += [(100 + k, "the common words at all texts") for k in range(n)]
        found = {r.doc_id: spans(r) for r in private_data.all_spans(table_of(docs)).collect()}
        assert found[1] == ["email:24:41"] and found[10] == ["phone:14:31"] and found[100] == []


def planted(given):
    """The documents, with names beside addresses of a domain, a person and a number, and one that is as common elsewhere."""
    rng = np.random.default_rng(4)
    docs = list(given)
    for k, i in enumerate(sorted(rng.choice(len(docs), 60, replace=False).tolist())):
        said = [f"Quillfeather wrote from someone{k}@quill.example.net", "Ottoline, +44 20 7946 0958, called", f"see Marrowby at 203.0.113.{k}",
                "Commonname was here", "Commonname told me@my.example.org"][k % 5]
        docs[i] = (docs[i][0], f"{docs[i][1] or ''}\n{said}.")
    return docs


def test_marks_against_brute_force(table_of, given):
    docs = [*planted(given), (9000, None), (9001, ""), (given[0][0], given[0][1])]
    marks = brute.private_marks(docs, private_data.base_spans)
    found = private_data.all_spans(table_of([(k, t) for k, (_, t) in enumerate(docs)])).collect()
    for row in found:
        text = docs[row.doc_id][1] or ""
        own = [tuple(s) for s in row.spans]
        base = [s for s in own if s[0] in private_data.BASE_KINDS]
        expected = [(marks[row.doc_id][w], a, b) for w, a, b in private_data.uncovered(text, base) if w in marks.get(row.doc_id, {})]
        assert own == base + sorted(expected, key=lambda s: (private_data.KINDS.index(s[0]), s[1]))
    assert {"quillfeather", "ottoline", "marrowby"} <= {w for own in marks.values() for w in own}
    assert "commonname" not in {w for own in marks.values() for w in own}


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_planted_names_are_marked_and_few_other_words(spark, sf):
    rows = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text").collect()
    docs = planted([tuple(r) for r in rows])
    texts = dict(docs)
    found = private_data.all_spans(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    names, other, words = collections.Counter(), 0, 0
    for row in found:
        if not row.spans:
            continue
        base = [tuple(s) for s in row.spans if s.kind in private_data.BASE_KINDS]
        words += sum(1 for _ in private_data.uncovered(texts[row.doc_id], base))
        for s in row.spans:
            if s.kind not in private_data.BASE_KINDS:
                word = texts[row.doc_id][s.start : s.end]
                names[word] += 1
                other += word not in ("Quillfeather", "Ottoline", "Marrowby", "called", "wrote", "someone")
    assert names["Quillfeather"] == names["Ottoline"] == names["Marrowby"] == 12 and not names["Commonname"]
    assert other <= 0.02 * words


def test_a_hub_of_many_entities_is_met_by_few_terms(table_of):
    hub = " ".join(f"x{k}@h{k}.example.org" for k in range(3000)) + " " + " ".join(f"word{k}" for k in range(3000))
    docs = [(1, hub), *[(10 + k, f"Zanzibari number{k} of x7@h7.example.org and word{k}") for k in range(9)]]
    docs += [(100 + k, f"the common words{k % 7} at all texts word{k}") for k in range(300)]
    found = {r.doc_id: spans(r) for r in private_data.all_spans(table_of(docs)).collect()}
    assert sum(s.startswith("email") for s in found[1]) == 3000 and len(found[1]) == 3000
    assert all(any(s == "secret:0:9" for s in found[10 + k]) for k in range(9))


def test_disclosing_terms_are_marked_in_the_whole_document(table_of):
    far = "the common words at all texts " * 20
    docs = [(k, f"Zanzibari {far}at envoy@example.org {far}the zanzibari {k}") for k in range(8)]
    docs += [(100 + k, far) for k in range(300)] + [(500, f"zanzibari {far}")]
    found = {r.doc_id: spans(r) for r in private_data.all_spans(table_of(docs)).collect()}
    text = docs[3][1]
    marked = [text[int(a):int(b)] for kind, a, b in (s.split(":") for s in found[3]) if kind != "email"]
    assert marked == ["Zanzibari", "zanzibari"]
    assert found[100] == found[500] == []


def check_packing(rows, size=2048):
    places = collections.defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= size
    return len(places)


def test_packing(spark, sf_dir, given, table_of, odd):
    rows = queries.op7_best_fit_packing(spark, sf_dir).collect()
    assert sorted(tuple(r)[:5] for r in rows) == brute.pieces(given, queries.WORD_BPE)
    assert check_packing(rows) <= 1.03 * math.ceil(sum(r.length for r in rows) / 2048) + 1
    packed = packing.pack_documents(table_of([*odd, odd[3], (None, None)]), queries.WORD_BPE, with_ids=True)
    check_packing(packed.collect())
    joined = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert joined[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == r.ids
    assert packing.pack_documents(table_of([]), queries.WORD_BPE).count() == 0


def test_packing_in_many_groups_and_rounds(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(packing, "GROUP", 100)
    pieces = spark.range(3000).select(F.col("id").alias("doc_id"), (F.pmod(F.xxhash64("id"), F.lit(400)) + 1).alias("length"))
    rows = packing.pack_pieces(pieces, 1000).collect()
    assert sorted(r.doc_id for r in rows) == list(range(3000))
    assert check_packing(rows, 1000) <= 1.01 * math.ceil(sum(r.length for r in rows) / 1000) + 1


def test_sum_of_squares_rule():
    lengths = np.random.default_rng(6).integers(1, 60, 500)
    sequence, offset, fill = packing.sum_of_squares(lengths, 64)
    count, gaps = collections.Counter(), {}
    for k in np.argsort(-lengths, kind="stable"):
        n, best = int(lengths[k]), None
        for gap in sorted(g for g, c in count.items() if c and g >= n):
            after = count + collections.Counter()
            after[gap] -= 1
            after[gap - n] += gap > n
            cost = sum(c * c for g, c in after.items() if g)
            best = min(best or (cost, gap), (cost, gap))
        new = count + collections.Counter({64 - n: 1})
        gap = best[1] if best and best[0] <= sum(c * c for c in new.values()) else 64
        assert gaps.get(sequence[k], 64) == gap
        if gap < 64:
            count[gap] -= 1
        gaps[sequence[k]] = gap - n
        if gap > n:
            count[gap - n] += 1
    assert fill.tolist() == [64 - gaps[s] for s in sequence]


def test_quality_model_on_held_out_rows(spark, oracle):
    rows = queries.op8_quality_classifier(spark, "/root/testdata/sf0.01").collect()
    labels = dict(oracle.sql("SELECT doc_id, quality FROM '/root/testdata/sf0.01/labels.parquet'").fetchall())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert len(held) > 50 and np.mean([a == b for a, b in held]) > 0.95


def test_the_worst_line_is_sought_in_the_whole_text():
    at = quality_model.FEATURES.index("worst_line")
    assert quality_model.statistics("a clean line\n##**!!ab\nthe last line")[at] == 0.75
    assert quality_model.statistics("a clean line\n\nthe last line")[at] == 0.0


def test_quality_model_of_odd_rows_and_without_labels(spark, table_of, odd):
    stats = quality_model.document_statistics(table_of([*odd, (None, "x")]))
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality_model.train(stats, none)
    assert {r.score for r in quality_model.score_statistics(stats, model).collect()} == {0.5}
    some = spark.createDataFrame([(i, k % 2) for k, (i, _) in enumerate(odd)] + [(7, 5), (8, None), (999, 1)], "doc_id long, quality int")
    scored = quality_model.score_documents(table_of([*odd, (None, "x")]), quality_model.train(stats, some)).collect()
    assert len(scored) == len(odd) + 1 and all(0 <= r.score <= 1 for r in scored)
    assert quality_model.score_documents(table_of([]), model).count() == 0


def test_isotonic():
    assert quality_model.isotonic(np.array([2, 2, 4]), np.array([2, 0, 3])).tolist() == [0.5, 0.5, 0.75]


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(8)
    d = len(quality_model.FEATURES)
    x = rng.normal(size=(20, d))
    waves = 20_000
    model = quality_model.QualityModel(
        np.zeros(d), np.ones(d), rng.normal(size=(d, waves)) / np.sqrt(d), rng.uniform(0, 2 * np.pi, waves), None, None, None
    )
    lifted = model.lifted(x)[:, 1 : waves + 1]
    kernel = np.exp(-((x[:, None] - x) ** 2).sum(axis=2) / (2 * d))
    assert np.abs(lifted @ lifted.T - kernel).max() < 0.05


def vectors_frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_near_vectors(spark, sf_dir, oracle):
    rows = oracle.sql("SELECT vec_id, embedding, label FROM embeddings").fetchall()
    assert tuples(queries.op9_vector_near_dedup(spark, sf_dir)) == brute.near_vectors(rows)


def test_near_vectors_of_planted_groups_and_odd_rows(spark):
    rng = np.random.default_rng(9)
    rows, n = [], 0
    for group in range(150):
        centre = rng.normal(size=24)
        for k in range(1 + group % 6):
            rows.append((n, (centre + rng.normal(size=24) * 0.12 * (k > 1)).astype(np.float32).tolist(), group % 3))
            n += 1
    crowd = rng.normal(size=24)
    rows += [(n + k, (crowd + rng.normal(size=24) * 0.1).astype(np.float32).tolist(), 1) for k in range(90)]
    nan, inf = float("nan"), float("inf")
    rows += [(5000, None, 1), (5001, [0.0] * 24, 1), (5002, [nan] * 24, 1), (5003, [inf] * 24, 1), (5004, [None] * 24, 1),
             (5005, rows[0][1], None), (5006, [], 1), (5007, [1.0, 2.0], 1), (5008, [2.0, 4.0], 1), (5009, [1e30] * 24, 2), (5010, [1e-30] * 24, 2)]
    expected = brute.near_vectors(rows)
    found = tuples(vector_dedup.near_vectors(vectors_frame(spark, rows), vector_dedup.PivotIndex(tile=16)), "vec_id", "n_links", "component_id", "kept")
    exact = {r[0]: r[1] for r in expected}
    assert all(r[1] <= exact[r[0]] for r in found)
    assert sum(r[1] for r in found) >= 0.97 * sum(exact.values())
    odd = [r for r in found if r[0] >= 5000]
    assert odd == [r for r in expected if r[0] >= 5000]
    assert vector_dedup.near_vectors(vectors_frame(spark, [])).count() == 0


def test_quality_rules(spark, sf_dir, given, table_of, odd):
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    expected = sorted((i, *brute.quality_counts(t)) for i, t in given)
    assert tuples(queries.op10_quality_rules(spark, sf_dir), *columns) == expected
    docs = table_of([*odd, odd[3]])
    ruled = line_rules.quality_rules(docs)
    assert tuples(ruled, *columns) == sorted((i, *brute.quality_counts(t)) for i, t in [*odd, odd[3]])
    assert set(docs.columns) <= set(ruled.columns)
    assert not any(r.kept for r in ruled.collect() if r.base_failed)
    assert line_rules.quality_rules(table_of([])).count() == 0


def test_lines_that_fail_are_dropped_and_documents_that_lose_much_rejected(table_of):
    good = " ".join(f"Sentence{k} number{k} says{k} something{k} else{k}." for k in range(20))
    bad = "Home | About | Contact | Products | Login | Help"
    docs = table_of([(1, f"{good}\n{bad}"), (2, f"{good[:300]}\n" + "\n".join(bad.replace(" |", f"{k} |") for k in range(20))), (3, good + "\nAll rights reserved.")])
    found = {r.doc_id: r for r in line_rules.quality_rules(docs).collect()}
    assert (found[1].cleaned_text, found[1].kept) == (good, True)
    assert not found[2].kept and not found[2].base_failed
    assert found[3].cleaned_text == good


def test_native_plans_hold_no_python(spark, sf_dir):
    for query in (queries.op2_rendezvous_sharding, queries.op10_quality_rules):
        plan = query(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_pieces_are_learnt_a_few_at_a_time(monkeypatch):
    from quayside.llm import word_ids

    tokenizer, most = word_ids.tokenizer_of(queries.WORD_BPE), []

    class Counted:
        def encode_batch_fast(self, new, **how):
            most.append(len(new))
            return tokenizer.encode_batch_fast(new, **how)

    monkeypatch.setattr(word_ids, "tokenizer_of", lambda path: Counted())
    texts = [" ".join(f"w{k}x{k * k}" for k in range(a, a + 9000)) for a in (0, 5000)]
    found = list(word_ids.WordIds(queries.WORD_BPE).encode(texts))
    assert max(most) <= 4096
    assert found == [np.array(tokenizer.encode(t, add_special_tokens=False).ids, np.uint32).tobytes() for t in texts]


def test_words_of_letters_are_learnt_by_the_line(monkeypatch):
    from quayside.llm import word_ids

    tokenizer, given = word_ids.tokenizer_of(queries.WORD_BPE), []

    class Counted:
        model, get_vocab = tokenizer.model, tokenizer.get_vocab

        def encode_batch_fast(self, new, **how):
            given.extend(new)
            return tokenizer.encode_batch_fast(new, **how)

    monkeypatch.setattr(word_ids, "tokenizer_of", lambda path: Counted())
    words = ["".join("acdefghilm"[int(c)] for c in str(k * k + 10**6)) for k in range(5000)]
    encoder = word_ids.WordIds(queries.WORD_BPE)
    # Small letters with combining marks, decomposed letters and case pairs beside plain words.
    texts = [" ".join(words), "Straße İstanbul क़ख़ ΣΑΣ ǅ ﬁx ét é ª x", ""]
    found = list(encoder.encode(texts))
    assert found == [np.array(tokenizer.encode(t, add_special_tokens=False).ids, np.uint32).tobytes() for t in texts]
    assert len(given) <= 10

    # Over its limit it forgets what is not needed at once, and learns nothing again that is.
    monkeypatch.setattr(word_ids, "KNOWN_PIECES", 5000)
    given.clear()
    [again] = encoder.encode([" ".join([*words[:4000], "newword"])])
    assert given == ["newword"] and len(encoder.known) == 4002
    assert again == b"".join(encoder.known[word] for word in [*words[:4000], "newword"]) and found[0].startswith(again[: -len(encoder.known["newword"])])
