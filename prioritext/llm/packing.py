"""Packing of token sequences by non-negative least squares on the length histogram.

1. Every text is tokenised once, its ids are closed by an end id and cut into
   pieces of at most ``window`` ids (only documents longer than a window are
   cut); the pieces are written to the shared folder with a row number.
2. The histogram of piece lengths, in steps of ``unit`` ids, goes to the
   driver: ``window / unit`` counts whatever the input.  Shallow combinations
   of lengths that fill a window exactly are enumerated (up to three lengths,
   or one length several times and another once), and non-negative least
   squares (active set) gives each a repeat count.
3. Pieces are dealt evenly to cells of bounded size by their row number, so
   neither a long document nor a repeated row makes one large.  Each cell
   takes its share of the repeat counts, rounded down to whole sequences that
   its pieces can fill, and packs the residual pieces by best fit, longest
   first.

Defined results
  null or empty text: the end id alone; null id: packed like any other;
  repeated rows: packed once each; very long text: cut into windows;
  ties: pieces of a length are taken in order of their row number;
  empty table: empty result; extra columns are not read.
"""

from __future__ import annotations

import bisect
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prioritext.llm.tables import table, written
from prioritext.llm.words import SEPARATOR, slices, split_words

WINDOW = 4_096
UNIT = 16
END_ID = 2
# Pieces that one cell (one task's unit of packing) takes, on average.
CELL_PIECES = 4_096
# Bytes of words and ids that a worker remembers (twice at most); a word beyond so many bytes never.
CACHE_BYTES = 16_000_000
LONGEST_REMEMBERED = 64
# Longer words go to the library, whose merges are queued.
LONGEST_PLAIN = 512
_ENTRY = 150  # bytes that a remembered word takes besides its own
# Words tokenised in one call of either library, and bytes of text whose words are numbered together.
CALL_WORDS = 512
CALL_PLAIN = 50_000
SLICE_BYTES = 6_000_000

_workers: dict[str, "WordIds"] = {}


class WordIds:
    """Ids of ASCII-white-space-separated words by a ``tokenizers`` file.

    For a tokenizer that composes and lowers letters and splits at white space
    and between letters and other characters, the ids of a text are the ids of
    its words one after the other.  Words of Latin letters, with a full stop or
    comma behind them or not, go through :class:`Merges`; all others go to the
    library as they are, and a worker remembers them.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # two generations: a word used lately survives when the cache is full
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.room = CACHE_BYTES
        vocabulary = self.tokenizer.get_vocab()
        self.merges = Merges(vocabulary)
        self.kind = "<u2" if max(vocabulary.values()) < 1 << 16 else "<u4"

    @classmethod
    def of_worker(cls, path: str) -> WordIds:
        if path not in _workers:
            _workers[path] = cls(path)
        return _workers[path]

    def _others(self, words: list[bytes]) -> list[bytes]:
        """The ids of words that aren't plain; unseen ones are tokenised together."""
        found = [self.known.get(w) or self.older.get(w) for w in words]
        new = [i for i, ids in enumerate(found) if ids is None]
        for low in range(0, len(new), CALL_WORDS):
            some = new[low : low + CALL_WORDS]
            for i, ids in zip(some, self._by_library([words[i] for i in some]), strict=True):
                found[i] = ids
        for word, ids in zip(words, found, strict=True):
            if len(word) <= LONGEST_REMEMBERED and word not in self.known:
                if self.room < 0:
                    self.known, self.older, self.room = {}, self.known, CACHE_BYTES
                self.known[word] = ids
                self.room -= len(word) + len(ids) + _ENTRY
        return found

    def _by_library(self, words: list[bytes]) -> list[bytes]:
        texts = [w.decode() for w in words]
        found = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
        begin = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
        raw = np.array(found.ids, dtype="<u4").tobytes()
        at = np.searchsorted([o[0] for o in found.offsets], begin).tolist() if raw else [0] * len(begin)
        return [raw[4 * low : 4 * high] for low, high in zip(at[:-1], at[1:], strict=True)]

    def _distinct(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(ids, begin, size)`` of the words ``data[start:end]``: word i has ``ids[begin[i]:begin[i] + size[i]]``."""
        begin, size = np.zeros(len(starts), dtype=np.int64), np.zeros(len(starts), dtype=np.int64)
        parts, held = [], 0
        plain, coded = self.merges.plain(data, starts, ends)
        at = np.flatnonzero(plain)
        for low in range(0, len(at), CALL_PLAIN):
            some = at[low : low + CALL_PLAIN]
            ids, begin_, size_ = self.merges.ids(coded, starts[some], ends[some])
            begin[some], size[some] = held + begin_, size_
            parts.append(ids)
            held += len(ids)
        at = np.flatnonzero(~plain)
        found = self._others([data[low:high].tobytes() for low, high in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
        size[at] = [len(f) // 4 for f in found]
        begin[at] = held + np.cumsum(size[at]) - size[at]
        parts.append(np.frombuffer(b"".join(found), dtype="<u4"))
        return np.concatenate(parts), begin, size

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers.

        One dictionary numbers the words, each distinct one is looked up once, and the ids are gathered by number.
        """
        words = split_words(texts)
        n = len(words.starts)
        if not n:
            return [b""] * len(texts)
        # a word with the white space behind it, up to the next word
        bounds = pa.py_buffer(np.append(words.starts, len(words.data)))
        listed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, bounds, pa.py_buffer(words.data)])
        listed = listed.dictionary_encode()
        starts = np.frombuffer(listed.dictionary.buffers()[1], dtype=np.int64)[: len(listed.dictionary) + 1]
        data = np.frombuffer(listed.dictionary.buffers()[2], dtype=np.uint8)
        inside = np.concatenate(([0], np.cumsum(~SEPARATOR[data[: starts[-1]]])))
        starts, length = starts[:-1], np.diff(inside[starts])
        ids, begin, size = self._distinct(data, starts, starts + length)
        number = listed.indices.to_numpy()
        each = size[number]
        ends = np.cumsum(each)
        flat = ids[np.arange(ends[-1]) + np.repeat(begin[number] - (ends - each), each)]
        raw, cuts = flat.tobytes(), (4 * np.concatenate(([0], ends))[words.first]).tolist()
        return [raw[low:high] for low, high in zip(cuts[:-1], cuts[1:], strict=True)]


class Merges:
    """Merges of words of Latin letters under a vocabulary with word ends, very many words a call.

    A word's last byte stands for its symbol with a word end, so it has a code
    of its own.  The 26 letters, the trailing bytes of the accented ones in
    lower case and their leading byte need 119 codes, which are characters of
    one byte; two marks and what stands between words have one each.
    """

    def __init__(self, vocabulary: dict[str, int], end: str = "</w>"):
        import tiktoken

        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [i for i in range(256) if i not in shown]
        byte_of = {chr(i): i for i in shown} | {chr(256 + n): i for n, i in enumerate(hidden)}
        last = [*range(97, 123), *range(0x9F, 0xC0)]
        inner = [*last, 0xC3]
        self.between = 127
        self.inner = np.array([inner.index(i) if i in inner else 255 for i in range(256)], dtype=np.uint8)
        self.last = np.array([len(inner) + last.index(i) if i in last else 255 for i in range(256)], dtype=np.uint8)
        marks = {46: 120, 44: 121}
        for mark, code in marks.items():
            self.last[mark] = self.inner[mark] = code
        ranks: dict[bytes, int] = {}
        for token, i in vocabulary.items():
            ended = token.endswith(end)
            raw = [byte_of.get(c) for c in (token.removesuffix(end) if ended else token)]
            if raw and all(c in inner for c in raw[: len(raw) - ended]) and (not ended or raw[-1] in last):
                code = self.inner[raw]
                if ended:
                    code[-1] = self.last[raw[-1]]
                ranks[code.tobytes()] = i
        ranks |= {bytes([code]): vocabulary[chr(mark) + end] for mark, code in marks.items() if chr(mark) + end in vocabulary}
        codes = [*range(len(inner) + len(last)), *marks.values()]
        self.fits = all(bytes([c]) in ranks for c in codes)
        if self.fits:
            self.end_id = max(vocabulary.values()) + 1
            ranks[bytes([self.between])] = self.end_id
            # a word's letters, a mark, or what stands between words
            words = f"[\\x00-\\x{len(inner) + len(last) - 1:02x}]+|[\\x78\\x79\\x7f]"
            self.library = tiktoken.Encoding("merges", pat_str=words, mergeable_ranks=ranks, special_tokens={})

    def plain(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which words are letters of the range and a mark behind them or none; and all bytes, lowered and coded."""
        if not self.fits or not len(starts):
            return np.zeros(len(starts), dtype=bool), data
        lowered = _LOWER[data]
        lead = data == 0xC3
        after = np.concatenate(([False], lead[:-1]))
        accent = after & (data >= 0x80) & (data <= 0xBF) & (data != 0x97) & (data != 0xB7)
        lowered[accent & (data < 0x9F)] += 0x20
        letter = accent | ((lowered >= 97) & (lowered <= 122))
        letter[:-1] |= lead[:-1] & accent[1:]
        good = np.concatenate(([0], np.cumsum(letter)))
        final = data[ends - 1]
        mark = ((final == 46) | (final == 44)) & (ends - starts > 1)
        core_end = ends - mark
        plain = (good[core_end] - good[starts] == core_end - starts) & (ends - starts <= LONGEST_PLAIN)
        coded = self.inner[lowered]
        coded[core_end - 1] = self.last[lowered[core_end - 1]]
        return plain, coded

    def ids(self, coded: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(ids, begin, size)`` of plain words."""
        length = ends - starts
        before = np.cumsum(length) - length
        out = np.full(int(length.sum()) + len(starts), self.between, dtype=np.uint8)
        place = np.arange(int(length.sum()))
        out[place + np.repeat(np.arange(len(starts)), length)] = coded[place + np.repeat(starts - before, length)]
        ids = np.array(self.library.encode_ordinary(out.tobytes().decode("ascii")), dtype="<u4")
        stop = np.flatnonzero(ids == self.end_id)
        begin = np.concatenate(([0], stop[:-1] + 1))
        return ids, begin, stop - begin


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def pieces(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """``(doc_id, start, length, doc_tokens, ids, task, row)``: every document's ids cut at multiples of ``window``."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, task, row = WordIds.of_worker(tokenizer_path), TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                ids = part.column("doc_id").to_pylist()
                out = [
                    (i, s // 4, len(e[s : s + 4 * window]) // 4, len(e) // 4, _narrow(e[s : s + 4 * window], words.kind))
                    for i, e in zip(ids, (e + end for e in words.encode(part.column("text"))), strict=True)
                    for s in range(0, len(e), 4 * window)
                ]
                cols = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), _PIECE_TYPES, strict=True)]
                cols += [pa.array([task] * len(out), pa.int32()), pa.array(range(row, row + len(out)), pa.int64())]
                row += len(out)
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "start", "length", "doc_tokens", "ids", "task", "row"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, start long, length long, doc_tokens long, ids binary, task int, row long"
    )


_PIECE_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())


def _narrow(ids: bytes, kind: str) -> bytes:
    return ids if kind == "<u4" else np.frombuffer(ids, dtype="<u4").astype(kind).tobytes()


def widened(ids: bytes, length: int) -> np.ndarray:
    """The ids of a piece of ``length``; 16-bit ones under a vocabulary that they hold, else 32-bit ones."""
    return np.frombuffer(ids, dtype="<u4" if len(ids) == 4 * length else "<u2").astype("<u4")


def combinations(units: int) -> list[tuple[int, ...]]:
    """Length combinations, in units, that fill a window exactly."""
    found = {(units,)}
    for a in range(1, units):
        for b in range(a, units):
            c = units - a - b
            if c == 0:
                found.add((a, b))
            elif c >= b:
                found.add((a, b, c))
        for times in range(2, units // a + 1):
            rest = units - times * a
            found.add(tuple(sorted((a,) * times + ((rest,) if rest else ()))))
    return sorted(found)


def nnls(matrix: np.ndarray, target: np.ndarray, tolerance: float = 1e-7) -> np.ndarray:
    """Non-negative least squares by the active-set method."""
    rows, cols = matrix.shape
    x, passive = np.zeros(cols), np.zeros(cols, dtype=bool)
    scale = max(float(np.abs(target).max(initial=0.0)), 1.0)
    for _ in range(3 * rows):
        gradient = matrix.T @ (target - matrix @ x)
        gradient[passive] = -np.inf
        new = int(gradient.argmax())
        if gradient[new] <= tolerance * scale:
            break
        passive[new] = True
        while True:
            at = np.flatnonzero(passive)
            part = matrix[:, at]
            trial = np.linalg.lstsq(part.T @ part, part.T @ target, rcond=None)[0]
            if trial.min(initial=1.0) > 0:
                x[:] = 0
                x[at] = trial
                break
            bad = trial <= 0
            step = np.min(x[at][bad] / np.maximum(x[at][bad] - trial[bad], 1e-300))
            x[at] += step * (trial - x[at])
            passive[at[(x[at] <= 1e-12 * scale)]] = False
            x[~passive] = 0
            if not passive.any():
                break
    return x


def repeat_counts(histogram: np.ndarray) -> list[tuple[tuple[int, ...], float]]:
    """Combinations with a positive repeat count for a histogram of lengths 1..len(histogram) units."""
    combos = combinations(len(histogram))
    matrix = np.zeros((len(histogram), len(combos)))
    for j, combo in enumerate(combos):
        for a in combo:
            matrix[a - 1, j] += 1
    x = nnls(matrix, histogram.astype(float))
    return [(combos[j], float(x[j])) for j in np.flatnonzero(x > 1e-9)]


def pack_cell(lengths: np.ndarray, plan: list[tuple[tuple[int, ...], float]], share: float, window: int, unit: int):
    """Sequences (lists of piece numbers) that hold all pieces of a cell."""
    size = -(-lengths // unit)
    waiting: dict[int, list[int]] = {}
    for piece in range(len(lengths) - 1, -1, -1):
        waiting.setdefault(int(size[piece]), []).append(piece)
    out: list[list[int]] = []
    for combo, x in sorted(plan, key=lambda p: -p[1]):
        need = {a: combo.count(a) for a in combo}
        repeats = min([int(x * share), *(len(waiting.get(a, ())) // n for a, n in need.items())])
        out += [[waiting[a].pop() for a in combo] for _ in range(repeats)]
    rest = sorted((p for w in waiting.values() for p in w), key=lambda p: (-lengths[p], p))
    space: list[tuple[int, int]] = []  # (free ids, sequence), sorted
    for p in rest:
        n = int(lengths[p])
        i = bisect.bisect_left(space, (n, -1))
        if i < len(space):
            free, sequence = space.pop(i)
            out[sequence].append(p)
        else:
            free, sequence = window, len(out)
            out.append([p])
        if free > n:
            bisect.insort(space, (free - n, sequence))
    return out


def pack(
    cut: DataFrame, window: int = WINDOW, unit: int = UNIT, digest: bool = False, keep_ids: bool = False
) -> DataFrame:
    """Each piece's ``sequence_id`` and ``offset`` beside its own columns.

    ``cut`` is a written table of pieces (see :func:`pieces`), so that row numbers stand.
    With ``digest`` a CRC-32 of a piece's 32-bit ids stands in place of the ids, with ``keep_ids`` beside them.
    """
    bins = window // unit
    counted = cut.groupBy(F.ceil(F.col("length") / unit).alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()
    histogram = np.zeros(bins)
    for row in counted:
        histogram[row["bin"] - 1] = row["n"]
    total = int(histogram.sum())
    # a piece that fills the window is a sequence by itself; the rest are combined
    plan = [((bins,), float(histogram[-1]))] + repeat_counts(np.append(histogram[:-1], 0)) if total else []
    n_cells = max(1, -(-total // CELL_PIECES))
    cells = cut.withColumn("cell", F.pmod(F.xxhash64("task", "row"), F.lit(n_cells)))

    def run(table_: pa.Table) -> pa.Table:
        table_ = table_.sort_by([("task", "ascending"), ("row", "ascending")])
        lengths = table_.column("length").to_numpy()
        packed = pack_cell(lengths, plan, len(lengths) / total, window, unit)
        sequence, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
        cell = table_.column("cell")[0].as_py()
        for number, members in enumerate(packed):
            sequence[members] = (cell << 32) + number
            offset[members] = np.cumsum(lengths[members]) - lengths[members]
        if digest:
            pairs = zip(table_.column("ids").to_pylist(), lengths.tolist(), strict=True)
            ids = {"ids_crc32": pa.array([zlib.crc32(widened(i, n).tobytes()) for i, n in pairs], pa.int64())}
        else:
            ids = {}
        if keep_ids or not digest:
            ids["ids"] = table_.column("ids")
        return pa.table(
            {c: table_.column(c) for c in ("doc_id", "start", "length", "doc_tokens")}
            | ids
            | {"sequence_id": sequence, "offset": offset}
        )

    content = "ids_crc32 long" + ", ids binary" * keep_ids if digest else "ids binary"
    return cells.groupBy("cell").applyInArrow(
        run, f"doc_id long, start long, length long, doc_tokens long, {content}, sequence_id long, offset long"
    )


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    window: int = WINDOW,
    end_id: int = END_ID,
    digest: bool = False,
    keep_ids: bool = False,
) -> DataFrame:
    """Every piece of every document with its ids (of one width, which the vocabulary gives), their digest or both."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return pack(written(pieces(docs, tokenizer_path, window, end_id), "pieces"), window, digest=digest, keep_ids=keep_ids)


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op10_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed to sequences of at most 4096 ids."""
    docs = table(spark, sf_dir, "documents")
    return pack_documents(docs, word_bpe_path(), digest=True).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )
