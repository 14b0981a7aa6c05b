"""Alignment of two tokenizers over the same bytes by sparse incidence products.

The tokens of a text under either tokenizer cut its bytes into runs.  Per
block of texts (bounded bytes) two incidence matrices are built by hand in
compressed row form: tokens of A by bytes, and tokens of B by bytes.

1. Row products (Gustavson) of A with the transpose of B have an entry for
   each pair of tokens that share bytes: the overlap links.
2. Offsets where tokens of both end cut the text into groups.  Incidence of
   tokens and groups gives, by the same product, the pairs that share a group;
   its entries are counted from the factors and expanded only on request, in
   blocks of rows, for a group's pairs grow with its square.
3. How many links of the whole corpus hold a pair of ids: every block sends
   each of its distinct pairs once with a number, Spark adds them up, finds
   the highest of each id of B, and sends the answer back to the blocks that
   asked; a block meets its pairs' totals by its own key.  A pair has a row
   per block at most, however frequent it is, and a block is bounded.

A block tokenises each of its distinct parts once: texts are cut at spaces
that no token reaches across, and documents by parts times parts by pairs,
again by row products, are the documents' links.

Defined results
  null or empty text, and texts whose joined token bytes differ from a space
  and the text: no tokens, zeros and an empty digest; null id: aligned like
  any other; repeated rows: each counts; very long text: a block by itself;
  ties of the highest number: all of them are best; empty table: empty result;
  extra columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prioritext.llm.tables import table, written
from prioritext.llm.words import slices

# Bytes of text in a block (one text at least).
BLOCK_BYTES = 8_000_000
# A stretch of bytes beyond this, with or without white space only, goes to the library with a queue of merges.
STRETCH = 1_000
# Parts of texts that are tokenised in one call.
CALL_PARTS = 2_048
# Entries of a shared-group product that are expanded at a time.
EXPANDED = 1_000_000

_CUT = re.compile(r"(?<=\S) ")

_workers: dict[tuple[str, str], "Tokenizers"] = {}


@dataclass
class Csr:
    """A sparse matrix by compressed rows; ``data`` is left out where every entry is one."""

    starts: np.ndarray  # bounds of the rows in ``columns``
    columns: np.ndarray
    width: int
    data: np.ndarray | None = None

    @property
    def rows(self) -> int:
        return len(self.starts) - 1

    def transposed(self) -> Csr:
        """Counting sort of the entries by column."""
        owner = np.repeat(np.arange(self.rows, dtype=np.int64), np.diff(self.starts))
        order = np.argsort(self.columns, kind="stable")
        starts = np.concatenate(([0], np.cumsum(np.bincount(self.columns, minlength=self.width))))
        return Csr(starts, owner[order], self.rows, None if self.data is None else self.data[order])

    def counted(self) -> Csr:
        """Equal entries of a row added up."""
        owner = np.repeat(np.arange(self.rows, dtype=np.int64), np.diff(self.starts))
        return _gathered(owner * max(1, self.width) + self.columns, self.data, self.rows, self.width)

    def slice(self, low: int, high: int) -> Csr:
        a, b = self.starts[low], self.starts[high]
        return Csr(self.starts[low : high + 1] - a, self.columns[a:b], self.width, None if self.data is None else self.data[a:b])


def _gathered(code: np.ndarray, value: np.ndarray | None, rows: int, width: int) -> Csr:
    """A matrix from entries ``row * width + column``; those of one place add up."""
    width = max(1, width)
    if len(code) > 1 and (code[1:] < code[:-1]).any():
        if value is None:
            code = np.sort(code)
        else:
            order = np.argsort(code, kind="stable")
            code, value = code[order], value[order]
    first = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1]))) if len(code) else np.zeros(0, dtype=np.int64)
    if value is None:
        value = np.diff(first, append=len(code))
    elif len(first):
        value = np.add.reduceat(value, first)
    code = code[first]
    return Csr(np.searchsorted(code, np.arange(rows + 1, dtype=np.int64) * width), code % width, width, value)


def row_products(left: Csr, right: Csr) -> Csr:
    """``left @ right``: each entry (i, k) of the left brings row k of the right to row i, where equal columns add up.

    Rows of the left are worked on in blocks of about ``EXPANDED`` brought entries (one row at least).
    """
    each = np.diff(right.starts)[left.columns]
    total = np.concatenate(([0], np.cumsum(each)))[left.starts]
    parts, low = [], 0
    while low < left.rows:
        high = max(low + 1, int(np.searchsorted(total, total[low] + EXPANDED, side="right")) - 1)
        parts.append(_row_block(left.slice(low, high), right, each[left.starts[low] : left.starts[high]]))
        low = high
    if len(parts) == 1:
        return parts[0]
    before = np.cumsum([0, *(len(p.columns) for p in parts)])
    none = np.zeros(0, dtype=np.int64)
    return Csr(
        np.concatenate([[0], *(p.starts[1:] + b for p, b in zip(parts, before, strict=False))]).astype(np.int64),
        np.concatenate([none, *(p.columns for p in parts)]),
        right.width,
        np.concatenate([none, *(p.data for p in parts)]),
    )


def _row_block(left: Csr, right: Csr, each: np.ndarray) -> Csr:
    begin = np.cumsum(each) - each
    at = np.arange(int(each.sum()), dtype=np.int64) + np.repeat(right.starts[left.columns] - begin, each)
    owner = np.repeat(np.repeat(np.arange(left.rows, dtype=np.int64), np.diff(left.starts)), each)
    value = None if right.data is None else right.data[at]
    if left.data is not None:
        value = np.repeat(left.data, each) * (1 if value is None else value)
    return _gathered(owner * max(1, right.width) + right.columns[at], value, left.rows, right.width)


def product_sizes(left: Csr, right: Csr) -> np.ndarray:
    """Entries of each row of ``left @ right`` where the rows of the left reach disjoint rows of the right."""
    each = np.concatenate(([0], np.cumsum(np.diff(right.starts)[left.columns])))
    return each[left.starts[1:]] - each[left.starts[:-1]]


def incidence(ends: np.ndarray) -> Csr:
    """Tokens by bytes, for tokens that cut bytes ``0 .. ends[-1]`` into runs."""
    size = int(ends[-1]) if len(ends) else 0
    return Csr(np.concatenate(([0], ends)), np.arange(size, dtype=np.int64), size)


def grouped(ends: np.ndarray, cuts: np.ndarray) -> Csr:
    """Tokens by groups: a token belongs to the group whose end is the first not before its own."""
    return Csr(np.arange(len(ends) + 1, dtype=np.int64), np.searchsorted(cuts, ends), len(cuts))


@dataclass
class Aligned:
    """Two tokenizers' tokens over the same bytes, several texts one after the other."""

    a: np.ndarray  # ids
    b: np.ndarray
    a_ends: np.ndarray  # byte offsets
    b_ends: np.ndarray

    def __post_init__(self):
        self.cuts = np.intersect1d(self.a_ends, self.b_ends, assume_unique=True)
        self.links = row_products(incidence(self.a_ends), incidence(self.b_ends).transposed())
        self.a_groups, self.b_groups = grouped(self.a_ends, self.cuts), grouped(self.b_ends, self.cuts)

    def group_link_counts(self) -> np.ndarray:
        """For each token of A, how many tokens of B share its group."""
        return product_sizes(self.a_groups, self.b_groups.transposed())

    def group_links(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(token of A, token of B)`` for all pairs that share a group, in blocks of bounded size."""
        members = self.b_groups.transposed()
        total = np.concatenate(([0], np.cumsum(product_sizes(self.a_groups, members))))
        low = 0
        while low < self.a_groups.rows:
            high = max(low + 1, int(np.searchsorted(total, total[low] + EXPANDED, side="right")) - 1)
            part = row_products(self.a_groups.slice(low, high), members)
            yield low + np.repeat(np.arange(high - low), np.diff(part.starts)), part.columns
            low = high

    def written_groups(self, digits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All groups as bytes ``a1,a2|b1;a3|b2,b3;`` and the bytes' bounds, one for each group; ``digits`` has a row for each id."""
        width = digits.shape[1]
        g_a, g_b = self.a_groups.columns, self.b_groups.columns
        n_a, n_b = np.bincount(g_a, minlength=len(self.cuts)), np.bincount(g_b, minlength=len(self.cuts))
        place_a = np.arange(len(self.a)) + (np.cumsum(n_b) - n_b)[g_a]
        place_b = np.arange(len(self.b)) + np.cumsum(n_a)[g_b]
        out = np.zeros((len(self.a) + len(self.b), width + 1), dtype=np.uint8)
        for place, ids, owner, last in ((place_a, self.a, g_a, ord("|")), (place_b, self.b, g_b, ord(";"))):
            out[place, :width] = digits[ids]
            mark = np.full(len(ids), ord(","), dtype=np.uint8)
            mark[np.flatnonzero(np.diff(owner, append=-1))] = last
            out[place, width] = mark
        used = out != 0
        ends = np.cumsum(used.sum(axis=1))[np.cumsum(n_a + n_b) - 1]
        return out[used], np.concatenate(([0], ends))


def _digits(ids: np.ndarray, width: int) -> np.ndarray:
    """Decimal digits as ASCII, leading zeros left blank."""
    powers = 10 ** np.arange(width - 1, -1, -1)
    digits = (ids[:, None] // powers % 10 + 48).astype(np.uint8)
    digits[(ids[:, None] < powers) & (powers > 1)] = 0
    return digits


class Tokenizers:
    """A byte-level pair-merging file (A) and a piece model (B), with the bytes of every token."""

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        vocabulary = self.a.get_vocab()
        byte_of = _byte_characters()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_sizes = np.array([len(t) for t in self.a_bytes], dtype=np.int64)
        self.b_sizes = np.array([len(t) for t in self.b_bytes], dtype=np.int64)
        self._a_size, self._b_size = self.a_sizes.tolist().__getitem__, self.b_sizes.tolist().__getitem__
        self.width = len(str(max(len(self.a_bytes), len(self.b_bytes))))
        self.digits = _digits(np.arange(max(len(self.a_bytes), len(self.b_bytes))), self.width)
        self.fast = self._ranks(a_path)
        # no piece with a space behind another character, so that spaces there end a piece
        self.cuttable = self.fast is not None and not any(b" " in t.lstrip(b" ") for t in self.b_bytes)

    @classmethod
    def of_worker(cls, a_path: str, b_path: str) -> Tokenizers:
        key = (a_path, b_path)
        if key not in _workers:
            _workers[key] = cls(a_path, b_path)
        return _workers[key]

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def _ranks(self, a_path: str):
        """The same merges as ranks, for the quicker library; None where the file's ids aren't in order of merging."""
        import tiktoken
        from public_tokenizers import PATTERN

        with open(a_path, encoding="utf-8") as f:
            said = json.load(f)
        merges = said["model"]["merges"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        vocabulary = said["model"]["vocab"]
        special = {t["content"] for t in said.get("added_tokens", ())}
        single = sum(len(t) == 1 for t in vocabulary)
        regular = said["pre_tokenizer"] and said["pre_tokenizer"].get("use_regex", True) and not said.get("normalizer")
        if not regular or [vocabulary.get(x + y) for x, y in pairs] != list(range(single, single + len(pairs))):
            return None
        ranks = {self.a_bytes[i]: i for t, i in vocabulary.items() if t not in special}
        return tiktoken.Encoding("merges", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def a_ids(self, texts: list[str], raw: list[bytes]) -> list[list[int]]:
        if self.fast is None:
            return self._slow(texts)
        long_ = [_long_stretch(r) for r in raw]
        out = [[] if slow else self.fast.encode_ordinary(t) for t, slow in zip(texts, long_, strict=True)]
        at = [i for i, slow in enumerate(long_) if slow]
        for i, ids in zip(at, self._slow([texts[i] for i in at]), strict=True):
            out[i] = ids
        return out

    def _slow(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def parts(self, text: str) -> list[str]:
        """The text cut where no token of either tokenizer can reach across; each part has a space before it.

        That is a space behind anything but white space: a token of A has white space only at its start, and no
        piece of B holds a space behind another character.
        """
        return _CUT.split(text) if self.cuttable and "▁" not in text else [text]

    def align(self, parts: list[str]) -> tuple[Aligned, np.ndarray, np.ndarray, np.ndarray]:
        """The parts' tokens over their bytes, one after the other; tokens of each under A and B; which are exact.

        A part whose joined token bytes are not a space and the part has no tokens.
        """
        a_flat, b_flat, n_a, n_b, exact = [], [], [], [], []
        for low in range(0, len(parts), CALL_PARTS):
            some = parts[low : low + CALL_PARTS]
            spaced = [" " + p for p in some]
            raw = [p.encode("utf-8", "replace") for p in spaced]
            a_all, b_all = self.a_ids(spaced, raw), self.b.encode(some, num_threads=1)
            a_bytes, b_bytes = self.a_bytes.__getitem__, self.b_bytes.__getitem__
            # bytes in order, and of the right number in each part: every part is exact
            same = [True] * len(some)
            whole = b"".join(raw)
            if not (
                b"".join(map(a_bytes, chain.from_iterable(a_all))) == whole
                and b"".join(map(b_bytes, chain.from_iterable(b_all))) == whole
                and all(sum(map(self._a_size, a)) == len(r) for r, a in zip(raw, a_all, strict=True))
                and all(sum(map(self._b_size, b)) == len(r) for r, b in zip(raw, b_all, strict=True))
            ):
                same = [
                    b"".join(map(a_bytes, a)) == r == b"".join(map(b_bytes, b))
                    for r, a, b in zip(raw, a_all, b_all, strict=True)
                ]
            exact += same
            for ids, flat, sizes in ((a_all, a_flat, n_a), (b_all, b_flat, n_b)):
                kept = [x if ok else [] for x, ok in zip(ids, same, strict=True)]
                sizes += map(len, kept)
                flat.append(np.fromiter(chain.from_iterable(kept), dtype=np.int64))
        none = np.zeros(0, dtype=np.int64)
        a, b = np.concatenate([none, *a_flat]), np.concatenate([none, *b_flat])
        aligned = Aligned(a, b, np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b]))
        return aligned, np.array(n_a, dtype=np.int64), np.array(n_b, dtype=np.int64), np.array(exact, dtype=bool)


def _byte_characters() -> dict[str, int]:
    """The visible character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [i for i in range(256) if i not in shown]
    return {chr(i): i for i in shown} | {chr(256 + n): i for n, i in enumerate(hidden)}


_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _long_stretch(raw: bytes) -> bool:
    if len(raw) <= STRETCH:
        return False
    blank = _BLANK[np.frombuffer(raw, dtype=np.uint8)]
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    return int(np.diff(np.concatenate(([-1], edges, [len(raw) - 1]))).max()) > STRETCH


_DOC = [
    ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("n_group_links", pa.int64()), ("groups_sha256", pa.string()),
    ("gaps", pa.binary()), ("numbers", pa.binary()),
]
_BLOCK_SCHEMA = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_group_links long,"
    " groups_sha256 string, gaps binary, numbers binary, pairs array<long>, times array<long>"
)
_PAIR = 1 << 32  # a pair of ids is one number: id of A times this, plus id of B


def _planes(x: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, first all lowest bytes, then the next ones: mostly zeros, which files compress."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def blocks(docs: DataFrame, a_path: str, b_path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Documents with their own results, and a row of distinct pairs for each block of documents.

    A document's links are the gaps between its pairs' places in the block's sorted pairs, and how often each is linked.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers, task, number = Tokenizers.of_worker(a_path, b_path), TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in slices(batch, "text", block_bytes):
                raw = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in part.column("text")]
                yield _block(tokenizers, raw, part.column("doc_id"), (task << 32) + number)
                number += 1

    return docs.select("doc_id", "text").mapInArrow(run, _BLOCK_SCHEMA)


class Numbering(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        return number


def _summed(values: np.ndarray, owner: np.ndarray, owners: int) -> np.ndarray:
    return np.bincount(owner, weights=values, minlength=owners).astype(np.int64)


def _block(tokenizers: Tokenizers, raw: list[bytes], doc_ids: pa.Array, block: int) -> pa.RecordBatch:
    docs, numbering = len(raw), Numbering()
    texts = [_decoded(r) for r in raw]
    used = [list(map(numbering.__getitem__, tokenizers.parts(t))) if t else [] for t in texts]
    aligned, n_a, n_b, exact = tokenizers.align(list(numbering))
    if not exact.all():
        # a text with a part that is not exact counts as a whole, which is exact or has no tokens
        for i, t in enumerate(texts):
            if len(used[i]) > 1 and not exact[used[i]].all():
                used[i] = [numbering[t]]
        if len(numbering) > len(exact):
            aligned, n_a, n_b, exact = tokenizers.align(list(numbering))
    n_parts = len(numbering)
    word = np.fromiter(chain.from_iterable(used), dtype=np.int64)
    doc_of_word = np.repeat(np.arange(docs), [len(u) for u in used])

    # what each distinct part holds
    part_of_a = np.repeat(np.arange(n_parts), n_a)
    each = np.diff(aligned.links.starts)
    part_of_link = np.repeat(part_of_a, each)
    code = np.repeat(aligned.a, each) * _PAIR + aligned.b[aligned.links.columns]
    pairs, place = np.unique(code, return_inverse=True)
    n_links = np.bincount(part_of_link, minlength=n_parts)
    n_group_links = _summed(aligned.group_link_counts(), part_of_a, n_parts)
    part_of_group = part_of_a[np.searchsorted(aligned.a_ends, aligned.cuts)]
    n_groups = np.bincount(part_of_group, minlength=n_parts)
    text, bounds = aligned.written_groups(tokenizers.digits)
    text, ends = text.tobytes(), bounds[np.cumsum(n_groups)].tolist()
    groups = [text[low : high - 1] for low, high in zip([0, *ends], ends, strict=False)]

    # documents by parts times parts by pairs: documents by pairs
    held = row_products(
        Csr(np.searchsorted(doc_of_word, np.arange(docs + 1)), word, n_parts).counted(),
        Csr(np.concatenate(([0], np.cumsum(n_links))), place, len(pairs)).counted(),
    )
    times = _summed(held.data, held.columns, len(pairs))
    gaps = np.diff(held.columns, prepend=0)
    begins = held.starts[:-1][held.starts[:-1] < held.starts[1:]]
    gaps[begins] = held.columns[begins]
    cut = list(zip(held.starts[:-1].tolist(), held.starts[1:].tolist(), strict=True))
    digests = [
        hashlib.sha256(b";".join(map(groups.__getitem__, u))).hexdigest() if u and n_a[u[0]] else "" for u in used
    ]
    sums = [_summed(x[word], doc_of_word, docs) for x in (n_a, n_b, n_groups, n_links, n_group_links)]
    found = [_planes(gaps[low:high]) for low, high in cut], [_planes(held.data[low:high]) for low, high in cut]
    columns = [
        _with_row(v if isinstance(v, pa.Array) else pa.array(v, t), None, t)
        for v, (_, t) in zip((doc_ids, *sums, digests, *found), _DOC, strict=True)
    ]
    longs = pa.list_(pa.int64())
    lists = [
        pa.concat_arrays([pa.nulls(docs, longs), pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v, pa.int64()))])
        for v in (pairs, times)
    ]
    key = pa.array(np.full(docs + 1, block), pa.int64())
    return pa.RecordBatch.from_arrays([key, *columns, *lists], names=["block", *(n for n, _ in _DOC), "pairs", "times"])


def _decoded(raw: bytes) -> str:
    """The text, or none where it isn't UTF-8: no token bytes can equal it."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return ""


def _with_row(values: pa.Array, last, kind: pa.DataType) -> pa.Array:
    return pa.concat_arrays([values, pa.array([last], kind)])


def pair_totals(cut: DataFrame) -> DataFrame:
    """``(pair, total, best)``: links of the corpus that hold a pair of ids, and whether no pair of its id of B has more."""
    each = cut.filter(F.col("pairs").isNotNull()).select(F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    totals = each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("total"))
    # the distinct pairs of two vocabularies, read twice
    totals = written(totals, "pairs")
    highest = totals.groupBy((F.col("pair") % _PAIR).alias("b")).agg(F.max("total").alias("highest"))
    both = totals.withColumn("b", F.col("pair") % _PAIR).join(highest, "b")
    return both.select("pair", "total", (F.col("total") == F.col("highest")).alias("best"))


def align(docs: DataFrame, a_path: str, b_path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: tokens, groups, links, and its links' numbers in the whole corpus."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    cut = written(blocks(docs, a_path, b_path, block_bytes), "aligned")
    asked = cut.filter(F.col("pairs").isNotNull()).select(F.col("block").alias("asker"), F.explode("pairs").alias("pair"))
    answers = asked.join(pair_totals(cut), "pair").select("asker", "pair", "total", "best")
    own = cut.filter(F.col("pairs").isNull()).drop("pairs", "times")
    names = [n for n, _ in _DOC if n not in ("gaps", "numbers")]

    def resolve(rows: pa.Table, totals: pa.Table) -> pa.Table:
        totals = totals.sort_by("pair")
        total = totals.column("total").to_numpy()
        best = totals.column("best").to_numpy().astype(bool)
        n_best, count_sum = [], []
        for gaps, numbers in zip(rows.column("gaps").to_pylist(), rows.column("numbers").to_pylist(), strict=True):
            place, times = np.cumsum(_from_planes(gaps)), _from_planes(numbers)
            count_sum.append(int((total[place] * times).sum()))
            n_best.append(int(times[best[place]].sum()))
        more = {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())}
        return pa.table({n: rows.column(n) for n in names} | more)

    schema = ", ".join(f"{n} {'string' if n == 'groups_sha256' else 'long'}" for n in names)
    return (
        own.groupBy("block")
        .cogroup(answers.groupBy("asker"))
        .applyInArrow(resolve, f"{schema}, n_best long, count_sum long")
    )


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents under the byte-level and the piece tokenizer, aligned on their bytes."""
    import public_tokenizers

    found = align(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )
    return found.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_group_links"
    )
