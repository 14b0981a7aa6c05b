"""Whitening, secret scan and token alignment: brute force, and the defined results of odd inputs."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from prioritext.llm import alignment, secret_scan, whitening
from prioritext.llm.secret_scan import BASE_62
from prioritext.llm.tables import table

# whitening


def _whitened(rows):
    """Brute force over rows of (id, vector): id -> rows of (deviation, eight values), up to sign."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    dim = max(len(v) for _, v in kept)
    x = np.array([[int(np.floor(1024 * c)) + 100_000 for c in v] + [100_000] * (dim - len(v)) for _, v in kept])
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(r, sums, strict=True)) for r in x]
    return [i for i, _ in kept], deviation, centred @ vectors / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def _check_whitened(got, rows):
    ids, deviation, want, explained = _whitened(rows)
    n, k = len(ids), got.select("component").distinct().count()
    found = sorted(got.collect(), key=lambda r: (r["component"], str(r["vec_id"]), r["deviation"], abs(r["whitened"])))
    assert len(found) == n * k and {r["n"] for r in found} == {n}
    assert max(r["identity_error"] for r in found) <= 1e-4
    for c in range(k):
        part = [r for r in found if r["component"] == c + 1]
        order = sorted(range(n), key=lambda j: (str(ids[j]), deviation[j], abs(want[j, c])))
        assert [r["vec_id"] for r in part] == [ids[j] for j in order]
        assert [r["deviation"] for r in part] == [deviation[j] for j in order]
        y, z = np.array([r["whitened"] for r in part]), want[order, c]
        assert min(np.abs(y - z).max(), np.abs(y + z).max()) < 1e-8
        assert part[0]["explained"] == pytest.approx(explained[c], rel=1e-9)
    return k


def test_whitening_equals_the_full_decomposition(spark, sf001):
    vectors = table(spark, sf001, "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    assert _check_whitened(whitening.whiten(vectors), rows) == 8


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.standard_normal(5) * [5, 4, 3, 2, 1]).tolist()) for i in range(60)]
    rows += [(None, [1.0, 2.0, 3.0, 4.0, 5.0]), (7, rows[7][1]), (7, rows[8][1]), (90, [1.0, -2.0]), (91, [])]
    odd = [(70, None), (71, [1.0, None, 2.0]), (72, [float("nan")] * 5), (73, [float("inf"), 0.0]), (74, [1e300] * 5)]
    schema = "vec_id long, embedding array<double>"
    vectors = spark.createDataFrame(rows + odd, schema).withColumns({"x": F.lit("y"), "n": F.lit(1), "whitened": F.lit(0)})
    assert _check_whitened(whitening.whiten(vectors), rows) == 5
    # a large shift with little variance keeps its precision
    far = [(i, (2000.0 + rng.integers(0, 9, 3) / 1024).tolist()) for i in range(40)]
    assert _check_whitened(whitening.whiten(spark.createDataFrame(far, schema)), far) == 3
    for few in ([], odd, [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])]):
        assert whitening.whiten(spark.createDataFrame(few, schema)).count() == 0


def test_jacobi_davidson_on_a_wide_matrix_with_near_equal_values():
    rng = np.random.default_rng(11)
    basis = np.linalg.qr(rng.standard_normal((300, 300)))[0]
    values = np.concatenate(([9, 8.999, 8.99, 5, 5, 4, 3, 2.5], rng.uniform(0, 2.4, 292)))
    matrix = (basis * values) @ basis.T
    found = whitening.jacobi_davidson(lambda u: matrix @ u, 300, 8)
    assert np.abs(found.values - np.sort(values)[::-1][:8]).max() < 1e-12 * 9
    assert found.residuals.max() <= 64 * whitening.PRECISION
    assert np.abs(found.vectors.T @ found.vectors - np.eye(8)).max() < 1e-12
    for i in (0, 1, 2, 5, 6, 7):
        assert abs(abs(found.vectors[:, i] @ basis[:, i]) - 1) < 1e-9


def test_deviations_beyond_a_long():
    rows = np.array([[0, 10**9], [10**9, 0]])
    assert whitening.deviations(rows, 2, [10**9, 10**9]).to_pylist() == [2 * 10**18, 2 * 10**18]
    assert whitening.deviations(rows * 4, 2, [4 * 10**9, 4 * 10**9]).to_pylist() == [None, None]


# secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")


def _base_spans(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 32]
    return [(("assign", "access", "hex")[k], s, e) for s, k, e in sorted(found)]


def _row(doc_id, text):
    spans = _base_spans(text)
    count = Counter(k for k, _, _ in spans)
    joined = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
    return doc_id, count["assign"], count["access"], count["hex"], hashlib.sha256(joined.encode()).hexdigest()


def _secret_texts():
    rng = np.random.default_rng(5)
    bits = [
        "password", "PASSWD", "Secret", "token", "api_key", "apikey", "APIKEY", "=", ":", " ", "  ", '"', "'", "abc1234",
        "abcd1234", "AKIA", "AKIA1234567890AB", "akia1234567890ab", "0123456789abcdef", "deadbeef", "\n", "é", "漢", "ſ", "K",
        "-", "/", "Z9",
    ]
    return ["".join(rng.choice(bits, rng.integers(1, 14))) for _ in range(1_500)]


def test_secret_scan_equals_plain_expressions(spark, tmp_path):
    texts = [None, "", "token=" + "a" * 7, "token=token=abcdefgh", "tokentoken: 'abcdefgh'", "x" * 300_000 + " secret = abcdefgh1",
             "AKIAAKIA12345678", "f" * 31, "f" * 32, "é" * 50 + "f" * 64 + "g" + "0" * 33, "passwordpassword =x12345678"]
    rows = [(i, t) for i, t in enumerate(texts + _secret_texts())] + [(None, "secret=abcdefgh"), (3, texts[3]), (3, texts[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"secrets": F.lit("x"), "spans": F.lit(1)})
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = secret_scan.op12_secret_scan(spark, str(tmp_path)).collect()
    columns = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256"]
    assert sorted((tuple(r[c] for c in columns) for r in got), key=str) == sorted((_row(*r) for r in rows), key=str)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert secret_scan.find_secrets(empty).count() == 0


def test_secret_scan_of_the_whole_table(spark, sf001):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf001, "documents").collect()]
    got = secret_scan.op12_secret_scan(spark, sf001).collect()
    columns = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256"]
    assert sorted(tuple(r[c] for c in columns) for r in got) == sorted(_row(*r) for r in rows)


def _checked_token(prefix, entropy):
    value, digits = zlib.crc32(entropy.encode()), ""
    for _ in range(6):
        value, d = divmod(value, 62)
        digits = chr(BASE_62[d]) + digits
    return prefix + entropy + digits


def test_checksums_decide(spark):
    good = _checked_token("ghp_", "0aB" * 10)
    bad = good[:-1] + ("A" if good[-1] != "A" else "B")
    texts = [
        f"é {good}.", bad, good + "x", "my card: 4111 1111 1111 1111 now", "card 4111 1111 1111 1112", "VISA no 4111111111111111",
        "IBAN: DE89 3704 0044 0532 0130 00", "iban DE88370400440532013000", "4111 1111 1111 1111",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: [tuple(s) for s in r["secrets"]] for r in secret_scan.find_secrets(docs).collect()}
    assert got[0] == [("vendor", 2, 42)] and got[1] == [] and got[2] == []
    assert got[3] == [("card", 9, 28)] and got[4] == [] and got[5] == [("card", 8, 24)]
    assert got[6] == [("account", 6, 33)] and got[7] == [] and got[8] == []
    hidden = {r["doc_id"]: r["text"] for r in secret_scan.masked(docs).collect()}
    assert hidden[0] == "é " + "*" * 40 + "." and hidden[1] == bad and hidden[3] == "my card: " + "*" * 19 + " now"


# alignment


@pytest.fixture(scope="module")
def paths():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _aligned(rows, paths):
    """Brute force: the libraries on whole texts, intervals compared one by one."""
    import sentencepiece
    from tokenizers import Tokenizer

    first, second = Tokenizer.from_file(paths[0]), sentencepiece.SentencePieceProcessor(model_file=paths[1])
    first.encode_special_tokens = True
    token, byte_of = {i: t for t, i in first.get_vocab().items()}, alignment._byte_characters()

    def spans(parts):
        ends = np.cumsum([len(p) for p in parts]).tolist()
        return list(zip([0, *ends], ends, strict=False))

    def piece(i):
        p = second.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()

    found, counts = [], Counter()
    for doc_id, text in rows:
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        a_parts, b_parts = [bytes(byte_of[c] for c in token[i]) for i in a], [piece(i) for i in b]
        if not text or not b"".join(a_parts) == b"".join(b_parts) == (" " + text).encode():
            found.append((doc_id, [], [], [], []))
            continue
        a_spans, b_spans = spans(a_parts), spans(b_parts)
        links, low = [], 0
        for i, (start, end) in zip(a, a_spans, strict=True):
            while b_spans[low][1] <= start:
                low += 1
            j = low
            while j < len(b) and b_spans[j][0] < end:
                links.append((i, b[j]))
                j += 1
        counts.update(links)
        cuts = sorted({e for _, e in a_spans} & {e for _, e in b_spans})
        at = np.searchsorted(cuts, [e for _, e in a_spans]), np.searchsorted(cuts, [e for _, e in b_spans])
        groups = [([], []) for _ in cuts]
        for side, ids in enumerate((a, b)):
            for i, g in zip(ids, at[side].tolist(), strict=True):
                groups[g][side].append(str(i))
        found.append((doc_id, a, b, links, groups))
    best: dict[int, int] = {}
    for (_, j), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    return [
        (
            doc_id, len(a), len(b), len(groups), len(links), sum(counts[p] == best[p[1]] for p in links),
            sum(counts[p] for p in links),
            hashlib.sha256(";".join(f"{','.join(x)}|{','.join(y)}" for x, y in groups).encode()).hexdigest() if a else "",
            sum(len(x) * len(y) for x, y in groups),
        )
        for doc_id, a, b, links, groups in found
    ]


def test_alignment_equals_brute_force(spark, sf001, paths):
    rng = np.random.default_rng(9)
    alphabet = list("ab \n\t'sé漢🎉́  ١²ǅʰᾳ०ⅷ_-09 ​㍿ᳲำ")
    texts = [
        None, "", "a", " ", "<|endoftext|> x", "<s> </s> <unk> <0x41>", "x" * 3_000, " " * 3_000 + "b", "▁ x", "x▁ y", "İ. é",
        "漢字テスト 한국어", "\x00 nul", "🎉👩‍👧 ok", "1234567 12.5e-7 it's WE'LL", "\n\n\t\r\n a    b　c", "-" * 100 + "=" * 67,
    ]
    texts += ["".join(rng.choice(alphabet, rng.integers(1, 60))) for _ in range(600)]
    texts += [r["text"] for r in table(spark, sf001, "documents").orderBy("doc_id").collect()]
    rows = [*enumerate(texts), (None, "a b"), (3, "a b"), (3, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"block": F.lit("x"), "pairs": F.lit(1)})
    want = sorted(_aligned(rows, paths), key=str)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_group_links"]
    for size in (20_000, alignment.BLOCK_BYTES):
        assert sorted((tuple(r) for r in alignment.align(docs, *paths, size).select(columns).collect()), key=str) == want


def test_alignment_of_nothing(spark, paths):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(empty, *paths).count() == 0
    bare = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert {tuple(r)[1:] for r in alignment.align(bare, *paths).collect()} == {(0, 0, 0, 0, 0, "", 0, 0)}


def test_row_products_and_group_links(paths, monkeypatch):
    rng = np.random.default_rng(2)
    left, right = rng.integers(0, 3, (40, 30)) * (rng.random((40, 30)) < 0.2), rng.integers(0, 3, (30, 50))

    def csr(m):
        return alignment.Csr(np.concatenate(([0], np.cumsum((m != 0).sum(axis=1)))), np.nonzero(m)[1], m.shape[1], m[m != 0])

    for size in (1, 100, 1_000_000):
        monkeypatch.setattr(alignment, "EXPANDED", size)
        got, out = alignment.row_products(csr(left), csr(right)), np.zeros((40, 50), dtype=np.int64)
        out[np.repeat(np.arange(40), np.diff(got.starts)), got.columns] = got.data
        assert (out == left @ right).all()
        aligned = alignment.Tokenizers.of_worker(*paths).align(["hello wörld 漢字", "x" * 40])[0]
        pairs = [p for a, b in aligned.group_links() for p in zip(a.tolist(), b.tolist(), strict=True)]
        a_group, b_group = aligned.a_groups.columns, aligned.b_groups.columns
        assert pairs == [(i, j) for i in range(len(a_group)) for j in range(len(b_group)) if a_group[i] == b_group[j]]
        assert aligned.group_link_counts().sum() == len(pairs)
