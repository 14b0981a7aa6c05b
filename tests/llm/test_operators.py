"""Every dealt operator: brute force, round trips, and the defined results of odd inputs."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from prioritext.llm import (
    chat,
    near_duplicates,
    packing,
    piecewise,
    quality,
    sharding,
    substrings,
    topk,
    toxicity,
    warc,
)
from prioritext.llm.tables import table
from prioritext.llm.words import cover, sliding_min, split_words, window_hashes

SCHEMA = "doc_id LONG, text STRING"
LONG = " ".join(f"w{i}" for i in range(60))
ODD = [
    (1, None), (2, ""), (3, " \n\t"), (4, "a b"), (None, "a b"), (5, LONG), (5, LONG), (6, LONG + " tail"),
    (7, "x " * 5_000), (None, None), (8, "É é  z"), (9, LONG.upper()),
]


@pytest.fixture(scope="module")
def odd(spark):
    # a clashing name in an extra column must not matter
    return spark.createDataFrame(ODD, SCHEMA).withColumns({"kept": F.lit(True), "shard": F.lit(1), "n_words": F.lit("x")})


def _words(text):
    return [] if text is None else text.encode().split()


def test_words_and_windows():
    texts = pa.array(["a bb\x0bc", None, "", "  d  ", "é f"])
    w = split_words(texts)
    assert w.counts.tolist() == [3, 0, 0, 1, 2]
    assert len(set(w.hashes().tolist())) == 6
    same = split_words(pa.array(["AB ab"]), lower=True).hashes()
    assert same[0] == same[1]
    x = np.random.default_rng(1).integers(0, 9, 50).astype(np.uint64)
    for k in (1, 5, 28):
        assert sliding_min(x, k).tolist() == [x[i : i + k].min() for i in range(51 - k)]
    h = window_hashes(np.tile(x, 2), 35)
    assert (h[:15] == h[50:65]).all()
    assert cover(np.array([True, False, False, True]), 2).tolist() == [True, True, False, True, True]


def test_quality_on_odd_rows_equals_brute_force(spark, odd):
    got = quality.score_quality(odd).collect()
    want = []
    for doc_id, text in ODD:
        w = _words(text)
        grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        hit = {i + j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in range(3)}
        want.append((doc_id, len(w), len(hit)))
    assert sorted(((r.doc_id, r.n_words, r.n_repeat_words) for r in got), key=str) == sorted(want, key=str)
    kept = {r.doc_id for r in got if r.kept}
    assert kept == {5, 6, 9}


def test_quality_order_never_changes_the_verdict(spark, sf001):
    docs = table(spark, sf001, "documents")
    a, b = (quality.keep_good(docs, r).select("doc_id") for r in (quality.RULES, quality.RULES[::-1]))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert {r.name for r in quality.ordered_rules(docs)} == {r.name for r in quality.RULES}


def _brute_removed(rows, k):
    seen = Counter(tuple(w[i : i + k]) for _, t in rows for w in [_words(t)] for i in range(len(w) - k + 1))
    out = []
    for doc_id, t in rows:
        w = _words(t)
        gone = {i + j for i in range(len(w) - k + 1) if seen[tuple(w[i : i + k])] > 1 for j in range(k)}
        left = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def test_substrings_on_odd_rows_equal_brute_force(spark, odd):
    got = substrings.removals(odd)
    assert sorted(map(tuple, got.collect()), key=str) == _brute_removed(ODD, 35)


def test_equal_rows_leave_one_set_of_spans(spark):
    rows = [(i, t) for i in (None, 7) for t in (LONG, LONG + " tail") for _ in range(50)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for r in substrings._with_spans(docs, 35, 8).collect():
        assert 0 < len(r._starts) <= len(_words(r.text))
        assert len(set(zip(r._starts, r._lengths, strict=True))) == len(r._starts)
    assert sorted(map(tuple, substrings.removals(docs).collect()), key=str) == _brute_removed(rows, 35)


def test_substrings_with_frequent_passages_in_changing_context(spark, monkeypatch):
    monkeypatch.setattr(substrings, "FREQUENT", 0.0)
    line = " ".join(f"p{i}" for i in range(40))
    rows = [(i, f"a{i} b{i} c{i} {line} d{i % 3} e{i} " + " ".join(f"{i}z{j}" for j in range(30))) for i in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert len(substrings.frequent_minimisers(docs, 35, 8))
    assert sorted(map(tuple, substrings.removals(docs).collect()), key=str) == _brute_removed(rows, 35)


def test_a_key_in_parts_marks_what_a_whole_key_does():
    rng = np.random.default_rng(3)
    rows = []
    for i in range(600):
        key = 5 if 100 <= i < 550 else i // 100
        n = int(rng.integers(1, 5))
        blob = None if i % 50 == 7 else b"".join(int(x).to_bytes(6, "little") for x in rng.integers(0, 90 if key == 5 else 700, n))
        rows.append({"key": key, "doc_id": None if i == 9 else i, "crc": i, "start": 10 * i, "n": n, "hashes": blob})
    rows.sort(key=lambda r: r["key"])
    schema = pa.schema(
        [("key", pa.int64()), ("doc_id", pa.int64()), ("crc", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("hashes", pa.binary())]
    )
    batches = [pa.RecordBatch.from_pylist(rows[i : i + 37], schema) for i in range(0, 600, 37)]

    def marked(at_least):
        parts = list(substrings._by_key(iter(batches), at_least))
        spans = [s for p in parts for s in substrings._repeated_runs(p).to_pylist()]
        return len(parts), {(s["doc_id"], s["crc"], s["start"] + j) for s in spans for j in range(s["n"])}

    whole, parts = marked(10_000), marked(60)
    assert whole[0] == 1 and parts[0] > 4
    assert whole[1] == parts[1] and whole[1]


def test_super_min_hash_estimates_similarity():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 4_000, dtype=np.uint64)
    for n in (20, 300, 4_000):
        a, b = base[:n], np.concatenate((base[: int(0.9 * n)], rng.integers(0, 2**63, n - int(0.9 * n), dtype=np.uint64)))
        sig = near_duplicates.super_min_hash(np.concatenate((a, b)), np.array([0, n, 2 * n]))
        true = int(0.9 * n) / (2 * n - int(0.9 * n))
        assert abs((sig[0] == sig[1]).mean() - true) < 0.12
        assert len(set(sig[0].tolist())) > 0.9 * min(n, near_duplicates.SLOTS)


def _brute_components(rows, percent):
    sets = {}
    for doc_id, t in rows:
        w = [] if t is None else t.encode().lower().split()
        s = frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
        sets[doc_id] = s
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_near_duplicates_with_a_large_group_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BLOCK_ROWS", 16)
    monkeypatch.setattr(near_duplicates, "BLOCK_SHINGLES", 4_000)
    rng = np.random.default_rng(7)
    base = [f"t{i}" for i in range(120)]
    rows = [(1, None), (2, ""), (3, "a b"), (4, "A b")]
    for i in range(5, 155):
        w = list(base)
        for at in rng.integers(0, 120, int(rng.integers(0, 5))):
            w[at] = f"m{rng.integers(0, 40)}"
        rows.append((i, " ".join(w)))
    got = near_duplicates.near_duplicate_groups(spark.createDataFrame(rows, SCHEMA), percent=85).collect()
    assert {r.doc_id: r.component_id for r in got} == _brute_components(rows, 85)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_sift_and_bands_follow_the_threshold():
    from math import comb

    assert near_duplicates.layout(85) == (25, 5, 125, 85)
    for percent in (1, 10, 50, 70, 80, 82, 85, 95, 99, 100):
        bands, rows, slots, least = near_duplicates.layout(percent)
        p = percent / 100
        assert bands * rows <= slots and 0 <= least <= slots
        assert (1 - p**rows) ** bands <= 1e-6
        assert sum(comb(slots, k) * p**k * (1 - p) ** (slots - k) for k in range(least)) <= 1e-6
    for percent in (0, 101):
        with pytest.raises(ValueError):
            near_duplicates.layout(percent)


def _pairs_at(percent, numbers, n):
    """Texts 2i and 2i + 1 whose shingle sets are just above ``percent`` similar, other pairs disjoint."""
    both = -(-2 * percent * n // (100 + percent))
    rows = []
    for i in numbers:
        common = [f"c{i}x{j}" for j in range(both + 4)]
        rows += [(2 * i + s, " ".join(common + [f"{'ab'[s]}{i}x{j}" for j in range(n - both)])) for s in (0, 1)]
    return rows


def test_pairs_at_a_threshold_of_70_are_all_linked(spark):
    rows = _pairs_at(70, range(60), 900)
    got = near_duplicates.near_duplicate_groups(spark.createDataFrame(rows, SCHEMA), percent=70).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: i - i % 2 for i, _ in rows}


def test_a_pair_at_80_with_few_equal_slots_is_linked(spark):
    rows = _pairs_at(80, (4962, 4963), 400)
    sig = near_duplicates.super_min_hash(*near_duplicates.shingle_sets(pa.array([t for _, t in rows])))
    assert (sig[2] == sig[3]).sum() < 85  # a sift fitted to 0.85 loses this pair
    got = near_duplicates.near_duplicate_groups(spark.createDataFrame(rows, SCHEMA), percent=80).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: i - i % 2 for i, _ in rows}


def test_near_duplicates_on_odd_rows(spark, odd):
    got = near_duplicates.near_duplicate_groups(odd, percent=85).collect()
    assert len(got) == len(ODD)
    root = {r.doc_id: r.component_id for r in got if r.doc_id is not None}
    assert (root[1], root[2], root[5], root[6], root[9]) == (1, 2, 5, 5, 5)
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)


def test_near_duplicate_stage_equals_brute_force(spark):
    import corpus_pipeline as cp

    rows = [(i, t) for i, t in _pairs_at(80, range(3), 60)] + [(i + 100, t) for i, t in _pairs_at(78, range(3, 6), 60)]
    # an id with two quite different texts, one of them repeated with other columns; rows without an id
    rows += [(50, LONG), (50, "another text altogether " + "q " * 20), (50, LONG), (None, LONG), (None, LONG), (51, None)]
    docs = spark.createDataFrame([(i, t, "en", f"s{n}", n) for n, (i, t) in enumerate(rows)], SCHEMA + ", lang STRING, source STRING, n_chars LONG")
    roots = _brute_components([r for r in rows if r[0] not in (None, 50)], 80) | {50: 50}
    assert sum(i != r for i, r in roots.items()) == 3
    want = {}
    for n, (i, t) in enumerate(rows):
        if i is None or roots[i] == i:
            want.setdefault((i, t, n if i is None else None), (i, t, "en", f"s{n}", n))
    for parts in (1, 5):
        got = cp.near_duplicate_stage(spark, docs.repartition(parts), "").collect()
        assert sorted(map(tuple, got), key=str) == sorted(want.values(), key=str)


def test_packing_on_odd_rows(spark, odd):
    got = packing.pack_documents(odd, packing.word_bpe_path()).collect()
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(packing.word_bpe_path())
    want = Counter((i, tuple([*plain.encode(t or "", add_special_tokens=False).ids, 2])) for i, t in ODD)
    assert sum(r.length for r in got) == sum(len(ids) * n for (_, ids), n in want.items())
    for r in got:
        whole = [ids for (i, ids) in want if i == r.doc_id and len(ids) == r.doc_tokens]
        assert any(tuple(packing.widened(r.ids, r.length)) == ids[r.start : r.start + r.length] for ids in whole)
    fill = Counter()
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill[r.sequence_id]
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= packing.WINDOW


def test_the_pipeline_returns_token_ids(spark, odd):
    import corpus_pipeline as cp
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(packing.word_bpe_path())
    long = [(20, " ".join(f"n{i}" for i in range(3_000))), (21, "É 日本 z")]
    docs = odd.select("doc_id", "text").filter("doc_id not in (5)").union(spark.createDataFrame(long, SCHEMA))
    want = Counter((r.doc_id, tuple([*plain.encode(r.text or "", add_special_tokens=False).ids, 2])) for r in docs.collect())
    got = cp.packing_stage(spark, docs, "").collect()
    assert sum(r.length for r in got) == sum(len(ids) * n for (_, ids), n in want.items())
    whole = {i: [] for i, _ in want if i is not None}
    for r in sorted(got, key=lambda r: r.start):
        ids = packing.widened(r.ids, r.length)
        assert len(ids) == r.length and zlib.crc32(ids.tobytes()) == r.ids_crc32
        if r.doc_id is not None:
            whole[r.doc_id] += ids.tolist()
    assert {(i, tuple(ids)) for i, ids in whole.items()} == {k for k in want if k[0] is not None}


def test_nnls_and_cells():
    rng = np.random.default_rng(2)
    a, x = rng.random((8, 5)), np.array([0, 2.0, 0, 1.0, 3.0])
    assert np.allclose(packing.nnls(a, a @ x), x, atol=1e-6)
    assert all(sum(c) == 32 for c in packing.combinations(32))
    lengths = rng.integers(1, 4_097, 900)
    size = np.bincount(-(-lengths // 64), minlength=65)[1:]
    plan = packing.repeat_counts(size)
    packed = packing.pack_cell(lengths, plan, 1.0, 4_096, 64)
    assert sorted(p for s in packed for p in s) == list(range(900))
    assert max(lengths[s].sum() for s in packed) <= 4_096
    assert lengths.sum() / (4_096 * len(packed)) > 0.93


def test_sharding_laws(spark, odd):
    got = sharding.external_shuffle(odd, bucket_bytes=2_000).collect()
    assert Counter((r.record.doc_id, r.record.text) for r in got) == Counter(ODD)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
        assert r.size == len((r.record.text or "").encode()) + 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    counts = [len(by.get(i, [])) for i in range(8)]
    assert max(counts) - min(counts) <= 1
    other = sharding.external_shuffle(odd, bucket_bytes=2_000, seed=7).collect()
    assert [(r.shard, r.slot, r.size) for r in got] != [(r.shard, r.slot, r.size) for r in other]


def test_sharding_is_native(spark, odd):
    plan = sharding.external_shuffle(odd)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_sharding_shuffles_records_once(spark, odd):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where the counts' size isn't known beforehand
    try:
        plan = sharding.external_shuffle(odd, bucket_bytes=2_000)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_top_k_with_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=9)]) for i in range(300)]
    rows += [(i, rows[0][1]) for i in range(300, 360)]
    rows += [(400, None), (401, [None] * 9), (402, [float("nan")] * 9), (None, [1.0] * 9), (420, [float("inf")] * 9)]
    vectors = topk.quantised(spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<FLOAT>"))
    got = topk.top_k(vectors, vectors.filter("id % 20 = 0"), 20).collect()
    good = {i: np.floor(np.array(v, dtype=np.float32).astype(float) * 64) for i, v in rows[:360]}
    for q in range(0, 360, 20):
        want = sorted(((-int(good[q] @ good[i]), i) for i in good if i != q))[:20]
        mine = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == q)
        assert mine == [(n + 1, i, -s) for n, (s, i) in enumerate(want)]


def test_chat_collapse_on_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(chat, "STRETCH", 2)
    base = [("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", None), (None, "e")]
    logs = {1: base[:2], 2: base[:2], 3: base, 4: base[:4], 5: base[1:], 6: [("user", "ab")], 7: base[:2] + [("user", "x")]}
    rows = [(c, i + (c == 4), r, t) for c, turns in logs.items() for i, (r, t) in enumerate(turns)]
    rows += [rows[0], (None, 0, "user", "a")]
    turns = spark.createDataFrame(rows, "conv_id LONG, turn LONG, role STRING, text STRING")
    got = chat.render(turns, chat.maximal_conversations(turns)).collect()
    assert {(r.conv_id, r.n_turns, r.n_copies) for r in got} == {(3, 5, 1), (5, 4, 1), (6, 1, 1), (7, 3, 1)}
    text = next(r.text for r in got if r.conv_id == 7)
    assert text == "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in logs[7])


def test_warc_cases(spark):
    schema = "record_id LONG, kind STRING, url STRING, ts LONG, headers MAP<STRING, STRING>, body STRING"
    u = "http://www.Example.org:80/a/?b=2&utm_x=1&a=1#f"
    rows = [
        (1, "response", u, 10, {"etag": "x", "server": "s"}, "old"),
        (2, "response", "https://example.org/a?a=1&b=2", 200_000, {"etag": "y"}, None),
        (3, "revisit", u, 10, {"etag": "x"}, None),
        (4, "revisit", u, 11, {"etag": "x", "date": "d", "server": "t"}, None),
        (5, "revisit", u, 150_000, {"etag": "z"}, None),
        (6, "revisit", u, 150_000, None, None),
        (7, "revisit", None, 5, None, None),
        (8, "revisit", u, 300_000, {"etag": "y"}, None),
        (4, "revisit", u, 11, {"etag": "x", "date": "d", "server": "t"}, None),
    ]
    got = warc.resolve_revisits(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.record_id, r.status, r.response_id, r.body) for r in got) == [
        (3, "no_response", None, None), (4, "resolved", 1, "old"), (4, "resolved", 1, "old"),
        (5, "validator_mismatch", None, None), (6, "no_validator", None, None), (7, "no_response", None, None),
        (8, "resolved", 2, None),
    ]
    assert next(r.headers for r in got if r.record_id == 4) == {"etag": "x", "server": "s", "date": "d"}


def test_urls_without_a_scheme_do_not_share_a_key(spark):
    schema = "record_id LONG, kind STRING, url STRING, ts LONG, headers MAP<STRING, STRING>, body STRING"
    urls = ["dns:a.example", "dns:b.example", "c.example/x", "<http://d.example/>", "<https://e.example/?q=1>", "", "urn:f"]
    rows = [(i, "response", u, 10 + i, {"etag": str(i)}, f"body{i}") for i, u in enumerate(urls)]
    rows += [(100 + i, "revisit", u, 50 + i, {"etag": str(i)}, None) for i, u in enumerate(urls)]
    rows.append((200, "revisit", "http://www.d.example", 90, {"etag": "3"}, None))
    rows.append((201, "revisit", "dns:unseen", 90, {"etag": "6"}, None))
    got = warc.resolve_revisits(spark.createDataFrame(rows, schema)).collect()
    want = [(100 + i, "resolved", i, f"body{i}") for i in range(len(urls))]
    want += [(200, "resolved", 3, "body3"), (201, "no_response", None, None)]
    assert sorted((r.record_id, r.status, r.response_id, r.body) for r in got) == want


def test_transducer_equals_the_library_and_round_trips(spark, odd, sf001):
    import sentencepiece

    model = piecewise.piece_bpe_path()
    plain = sentencepiece.SentencePieceProcessor(model_file=model)
    docs = table(spark, sf001, "documents").select("doc_id", "text").union(odd.select("doc_id", "text"))
    docs = docs.union(spark.createDataFrame([(90, "日本 ﬁ\x00 <s>  \U0001F600\n")], SCHEMA))
    texts = Counter((r.doc_id, r.text) for r in docs.collect())
    got = piecewise.encode_texts(docs, model).collect()
    assert Counter((r.doc_id, r.decoded) for r in got) == texts
    for r in got:
        want = None if r.decoded is None else np.array(plain.encode(r.decoded), "<u4").tobytes()
        assert r.ids == want and r.ids_crc32 == (None if want is None else zlib.crc32(want))


def test_transducer_cuts_where_nothing_merges_and_finds_the_shortest_path():
    with open(piecewise.piece_bpe_path(), "rb") as f:
        machine = piecewise.Transducer(f.read())
    assert machine.stretch.findall("▁one,▁Two!日本") == ["▁one", ",", "▁Two", "!", "日", "本"]
    rng = np.random.default_rng(5)
    pieces = sorted(p for p in machine.ids if p.strip(piecewise.BLANK).isascii())
    for picked in rng.integers(0, len(pieces), (500, 3)):
        for stretch in machine.stretch.findall("".join(pieces[i] for i in picked)):
            want = [machine.ids[p] for p in machine._merged(stretch)]
            assert machine._path(stretch) == want == machine._shortest(stretch)
    # fewer pairs of pieces are tried than the whole lattice has
    machine.stable.clear()
    machine._path("▁international")
    assert len(machine.stable) < 5


def test_toxicity_held_out_and_odd_rows(spark, odd, sf01):
    docs, labels = table(spark, sf01, "documents"), table(spark, sf01, "labels")
    held = labels.filter("doc_id % 4 = 0")
    model = toxicity.fitted_model(docs, labels.filter("doc_id % 4 <> 0"))
    scored = toxicity.score_toxicity(docs.select("doc_id", "text"), model).join(held.select("doc_id", F.col("toxic").alias("y")), "doc_id")
    c = Counter((r.y, r.toxic) for r in scored.collect())
    assert (c[1, True] + c[0, False]) / sum(c.values()) > 0.9
    assert toxicity.score_toxicity(odd.select("doc_id", "text"), model).count() == len(ODD)
    empty = labels.filter("false")
    assert toxicity.keep_clean(odd, toxicity.fitted_model(docs, empty)).count() == len(ODD)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert quality.score_quality(none).isEmpty()
    assert quality.keep_good(none).isEmpty()
    assert substrings.removals(none).isEmpty()
    assert near_duplicates.near_duplicate_groups(none).isEmpty()
    assert packing.pack_documents(none, packing.word_bpe_path()).isEmpty()
    assert sharding.external_shuffle(none).isEmpty()
    assert piecewise.encode_texts(none, piecewise.piece_bpe_path()).isEmpty()
    vectors = topk.quantised(spark.createDataFrame([], "vec_id LONG, embedding ARRAY<FLOAT>"))
    assert topk.top_k(vectors, vectors, 3).isEmpty()
    turns = spark.createDataFrame([], "conv_id LONG, turn LONG, role STRING, text STRING")
    assert chat.render(turns, chat.maximal_conversations(turns)).isEmpty()
    pages = spark.createDataFrame([], "page_id LONG, url STRING, html STRING")
    assert warc.resolve_revisits(warc.crawl_records(pages)).isEmpty()
    labels = spark.createDataFrame([], "doc_id LONG, quality INT, toxic INT")
    assert toxicity.score_toxicity(none, toxicity.fitted_model(none, labels)).isEmpty()


def test_pipeline_stages(spark, sf001, odd):
    import corpus_pipeline as cp

    docs = table(spark, sf001, "documents")
    extra = odd.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(0).cast("long").alias("n_chars"), "kept")
    docs = docs.withColumn("kept", F.lit(1)).unionByName(extra.withColumn("kept", F.lit(2)))
    for _, stage in cp.STAGES[:-1]:
        after = cp.written(stage(spark, docs, sf001), "test")
        assert tuple(after.columns) == cp.COLUMNS
        assert 0 < after.count() <= docs.count()
        docs = after
    packed = cp.STAGES[-1][1](spark, docs, sf001)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_word_ids_equal_the_library_on_odd_words():
    rng = np.random.default_rng(4)
    bits = [
        "<|endoftext|>", "<|ENDOFTEXT|>", "<|EndOfText|>", "<|STARTOFTEXT|>", "İ", "İ.", "ı", ".", ",", "...", " ", "\n", "́",
        "̇", "e", "É", "ß", "ẞ", "Σ", "ς", "ǅ", "ﬁ", "K", "漢", "가", "ᄀ", "ᅡ", "1", "²", "'s", "don't", "Word", "WÖRT", "-",
        "🎉", "‍", "\x0b", "\x1c", "\x85", "\x00", "ŉ", "Ŀ", "ſ", "ĳ", "Ÿ", "×", "÷",
    ]
    texts = ["".join(rng.choice(bits, rng.integers(1, 12))) for _ in range(20_000)]
    texts += ["a" * 600, "a" * 600 + ".", "é" * 40, " ".join(rng.choice(bits, 5_000))]
    words = packing.WordIds.of_worker(packing.word_bpe_path())
    got = words.encode(pa.array([None, *texts, ""]))
    want = [e.ids for e in words.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [[], *want, []]


def test_every_set_of_an_id_is_linked(spark):
    rng = np.random.default_rng(8)
    sets = [" ".join(rng.choice(list("abcdefghijklmnop"), 30)) for _ in range(5)]
    rows = [(7, s) for s in sets] + [(1, sets[0]), (3, sets[1]), (5, sets[2]), (9, sets[3]), (2, "alone here")]
    for parts in (1, 4):
        docs = spark.createDataFrame(rows, SCHEMA).repartition(parts)
        got = {r.doc_id: (r.component_id, r.kept) for r in near_duplicates.near_duplicate_groups(docs, 85).collect()}
        assert got == {1: (1, True), 2: (2, True), 3: (1, False), 5: (1, False), 7: (1, False), 9: (1, False)}


def test_colliding_window_hashes_remove_nothing(spark, monkeypatch):
    rng = np.random.default_rng(6)
    texts = [" ".join(f"v{i}" for i in rng.integers(0, 10**6, 200)) for _ in range(40)]
    passage = " ".join(f"p{i}" for i in range(50))
    texts += [f"{texts[0][:60]} {passage} end{i}" for i in range(2)]
    plain = substrings.window_hashes

    def cut(words, k, *roll):
        full = plain(words, k, *roll)
        return full if roll else full & np.uint64(0xFFF)  # the first hash and the minimisers collide everywhere

    monkeypatch.setattr(substrings, "window_hashes", cut)
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(42), pa.int64()), "text": pa.array(texts, pa.large_string())})
    for reach in (1, 42):  # windows of one slice, and of slices that meet under their keys
        parts = [b for low in range(0, 42, reach) for b in substrings._paths(batch.slice(low, reach), 35, 8, np.zeros(0, np.uint64))]
        rows = pa.Table.from_batches(parts).sort_by("key").combine_chunks()
        found = substrings._repeated_runs(rows)
        assert set(found.column("doc_id").to_pylist()) == {40, 41}


def test_labels_of_other_documents_do_not_crowd_out(spark):
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(50)], SCHEMA)
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)] + [(i, 1) for i in range(1_000, 4_000)], "doc_id LONG, toxic INT")
    assert toxicity.labelled_sample(docs, labels, rows=60).count() == 50
    assert toxicity.labelled_sample(docs, labels, rows=20).count() == 20


def test_hot_rows_spread_over_buckets_and_shards_are_written(spark, tmp_path):
    equal = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("same text").alias("text"))
    docs = equal.union(spark.range(20_000).select(F.col("id"), F.concat(F.lit("text "), "id"))).withColumn("bucket", F.lit("x"))
    out = sharding.external_shuffle(docs, bucket_bytes=60_000)
    sharding.write_shards(out, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    places = back.groupBy("_shard").agg(F.count("_slot").alias("n"), F.countDistinct("_slot").alias("d"), F.max("_slot").alias("m")).collect()
    assert [(r.n, r.d, r.m) for r in places] == [(5_000, 5_000, 4_999)] * 8
    assert back.filter("doc_id is null").count() == 20_000 and back.select("doc_id", "text").distinct().count() == 20_001
    per_task = out.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.count("*")).first()
    assert per_task[0] < 8_000
