"""SentencePiece encoding and decoding by a weighted finite-state transducer.

A model file is compiled to three machines: the normaliser (blank to the
visible blank, one put in front), the pieces (a trie whose arcs read
characters and emit a piece), and the byte fallback (an arc for any character
without a piece, emitting its UTF-8 bytes).  A text composed with them is a
lattice over its characters; its encoding is the shortest path in the
tropical semiring.

For a pair-merging model the weight of an arc depends on the arc before it:
one where merging would leave the two pieces side by side, infinite where it
would join across their border first.  A path is finite exactly if all its
neighbours are stable, and then it is the merges' own result for the text up to
there: each place has one finite path, so the search goes forward along finite
arcs, the longest piece first, and steps back where none goes on.  For
a unigram model an arc weighs minus its piece's score.

No piece holds a visible blank behind another character, and nothing merges
across a character without a piece, nor between two characters that stand side
by side in no piece, so paths are found per stretch between
those borders; a worker remembers the stretches it has met.

Defined results
  null text: null ids and null decoded text; empty text: no ids, decoded
  empty; null id: encoded like any other; repeated rows: each by itself;
  very long text: whole, stretch by stretch; ties: the path whose last piece
  is longest; control characters and any other text without a piece: bytes;
  empty table: empty result; extra columns are not read.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prioritext.llm.tables import table
from prioritext.llm.words import slices

BLANK = "▁"
CACHE_STRETCHES = 500_000  # twice at most
_INFINITE = float("inf")
_NORMAL, _UNKNOWN, _BYTE = 1, 2, 6
_UNIGRAM, _BPE = 1, 2

_workers: dict[str, "Transducer"] = {}


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind)
        size = varint() if size is None else size
        yield tag >> 3, raw[at : at + size]
        at += size


class Transducer:
    """A compiled SentencePiece model."""

    def __init__(self, model: bytes):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        kind, norm = _UNIGRAM, {}
        for number, value in _fields(model):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece.get(1, b"").decode())
                self.scores.append(float(np.frombuffer(piece[2], "<f4")[0]) if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, _NORMAL))
            elif number == 2:
                kind = dict(_fields(value)).get(3, _UNIGRAM)
            elif number == 3:
                norm = dict(_fields(value))
        if norm.get(2):
            raise ValueError("models with a character map are not supported")
        if kind not in (_UNIGRAM, _BPE):
            raise ValueError("word and character models are not supported")
        self.bpe = kind == _BPE
        self.front, self.trim = bool(norm.get(3, 1)), bool(norm.get(4, 1))
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == _NORMAL}
        self.score_of = {p: self.scores[i] for p, i in self.ids.items()}
        self.unknown = self.kinds.index(_UNKNOWN)
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == _BYTE}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        if any(BLANK in p.lstrip(BLANK) for p in self.ids):
            raise ValueError("pieces with an inner blank are not supported")
        # the trie: a state is a prefix of a piece, with the piece that ends there or -1
        self.arcs = dict.fromkeys((p[:n] for p in self.ids for n in range(1, len(p))), -1) | self.ids
        # the same by characters (None: the piece that ends here), each piece's length and its longest proper prefix
        self.trie: dict = {}
        self.shorter, self.sizes = [-1] * len(self.pieces), [len(p) for p in self.pieces]
        for p, i in sorted(self.ids.items()):
            node = self.trie
            for c in p:
                self.shorter[i] = node.get(None, self.shorter[i])
                node = node.setdefault(c, {})
            node[None] = i
        known = {c for p in self.ids for c in p if len(c) == 1 and c in self.ids}
        self.alphabet = known
        # where scores tell all pieces apart, stable neighbours make one path only; runs of blanks may share a score
        scored = [self.scores[i] for p, i in self.ids.items() if not p.startswith(BLANK * 2)]
        self.one_path = self.bpe and len(set(scored)) == len(scored)
        # stretches: blanks and what may merge up to the next border, or a run without pieces
        groups, lone = self._groups(known - {BLANK})
        inside = "".join(map(re.escape, sorted(known - {BLANK})))
        cut = [f"{BLANK}*[{''.join(map(re.escape, g))}]+" for g in groups]
        cut += [f"{BLANK}*[{''.join(map(re.escape, lone))}]"] if lone else []
        self.stretch = re.compile("|".join([*cut, f"{BLANK}+", f"[^{inside}{BLANK}]+"]))
        self.stable: dict[int, float] = {}
        self.paths: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _groups(self, letters: set[str]) -> tuple[list[list[str]], list[str]]:
        """The letters in groups that no piece crosses, largest first, and those beside no other in any piece."""
        beside: dict[str, set[str]] = {}
        for piece in self.ids:
            tail = piece.lstrip(BLANK)
            for a, b in zip(tail, tail[1:]):
                if a in letters and b in letters:
                    beside.setdefault(a, set()).add(b)
                    beside.setdefault(b, set()).add(a)
        groups, met = [], set()
        for c in sorted(beside):
            group, todo = set(), {c} - met
            while todo:
                group |= todo
                todo = set().union(*(beside[x] for x in todo)) - group
            met |= group
            groups += [sorted(group)] if group else []
        return sorted(groups, key=len, reverse=True), sorted(letters - met)

    @classmethod
    def of_worker(cls, name: str, model: bytes) -> Transducer:
        if name not in _workers:
            _workers[name] = cls(model)
        return _workers[name]

    # -- the normaliser

    def normalised(self, text: str) -> str:
        if self.trim:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        return ((" " if self.front else "") + text).replace(" ", BLANK)

    # -- weights of a merging model

    def _merged(self, text: str) -> list[str]:
        """Pieces of a short string by merging the best-scored pair, leftmost first."""
        out, score = list(text), self.score_of
        pairs = [score.get(a + b, -_INFINITE) for a, b in zip(out, out[1:])]
        while pairs and (best := max(pairs)) > -_INFINITE:
            at = pairs.index(best)
            out[at : at + 2] = [out[at] + out[at + 1]]
            del pairs[at]
            for i in range(max(at - 1, 0), min(at + 1, len(pairs))):
                pairs[i] = score.get(out[i] + out[i + 1], -_INFINITE)
        return out

    # -- shortest paths

    def _arc(self, last: int, piece: int) -> float:
        """Weight of a piece's arc behind the arc of another (-1: the first)."""
        if not self.bpe:
            return -self.scores[piece]
        key = last * len(self.pieces) + piece
        known = self.stable.get(key)
        if known is None:
            # merging the characters must leave just these pieces
            alone = [self.pieces[piece]] if last < 0 else [self.pieces[last], self.pieces[piece]]
            known = self.stable[key] = 1.0 if self._merged("".join(alone)) == alone else _INFINITE
        return known

    def _path(self, stretch: str) -> list[int]:
        whole = self.ids.get(stretch)
        if whole is not None and self.bpe and self._arc(-1, whole) < _INFINITE:
            return [whole]
        if self.one_path and not stretch.startswith(BLANK * 2):
            return self._only_path(stretch)
        return self._shortest(stretch)

    def _only_path(self, stretch: str) -> list[int]:
        """The one path of finite weight: no place is reached twice, so a step back is final."""
        n, trie, arc, shorter, sizes = len(stretch), self.trie, self._arc, self.shorter, self.sizes
        stable, width = self.stable, len(self.pieces)
        out: list[int] = []
        at, last, piece = 0, -1, -1
        while at < n:
            if piece < 0:  # the longest piece from here
                node, end = trie, None
                for c in stretch[at:]:
                    node = node.get(c)
                    if node is None:
                        break
                    end = node.get(None, end)
                piece = -1 if end is None else end
            while piece >= 0:
                cost = stable.get(last * width + piece)
                if (arc(last, piece) if cost is None else cost) < _INFINITE:
                    break
                piece = shorter[piece]
            if piece >= 0:
                out.append(piece)
                at += sizes[piece]
                last, piece = piece, -1
                continue
            # no arc goes on: the next shorter piece in place of the last one
            while piece < 0:
                back = out.pop()
                at -= sizes[back]
                piece = shorter[back]
            last = out[-1] if out else -1
        return out

    def _shortest(self, stretch: str) -> list[int]:
        n, arcs, arc, bpe = len(stretch), self.arcs, self._arc, self.bpe
        weight, begin, last = [0.0] + [_INFINITE] * n, [0] * (n + 1), [-1] * (n + 1)
        for i in range(n):
            for j in range(i + 1, n + 1):
                piece = arcs.get(stretch[i:j])
                if piece is None:
                    break
                if piece < 0 or (bpe and weight[j] < _INFINITE):
                    continue
                cost = weight[i] + arc(last[i], piece)
                if cost <= weight[j] and cost < _INFINITE:
                    weight[j], begin[j], last[j] = cost, i, piece
        out, at = [], n
        while at:
            out.append(last[at])
            at = begin[at]
        return out[::-1]

    def _fallback(self, run: str) -> list[int]:
        if not self.bytes:
            return [self.unknown] * len(run)
        return [self.bytes[b] for b in run.encode()]

    def _ids(self, stretch: str) -> bytes:
        known = stretch[0] == BLANK or stretch[0] in self.alphabet
        ids = self._path(stretch) if known else self._fallback(stretch)
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        stretches = self.stretch.findall(self.normalised(text))
        known = self.paths
        try:
            return b"".join(map(known.__getitem__, stretches))
        except KeyError:
            pass
        # two generations: a stretch met lately survives when the cache is full
        if len(known) > CACHE_STRETCHES:
            self.older, self.paths = known, {}
            known = self.paths
        if len(self.stable) > CACHE_STRETCHES:
            self.stable.clear()
        for s in set(stretches).difference(known):
            known[s] = self.older.get(s) or self._ids(s)
        return b"".join(map(known.__getitem__, stretches))

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are not UTF-8 become replacement characters."""
        if not hasattr(self, "spelled"):
            self.spelled = [
                bytes([self.byte_of[i]]) if i in self.byte_of else p.replace(BLANK, " ").encode() if k == _NORMAL else b""
                for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True))
            ]
        raw = b"".join(map(self.spelled.__getitem__, ids.tolist())).decode(errors="replace")
        return raw[1:] if self.front and raw.startswith(" ") else raw


def encode_texts(docs: DataFrame, model_path: str, keep_ids: bool = True) -> DataFrame:
    """``(doc_id, n_ids, ids_crc32, decoded, ids)`` of every row of ``docs(doc_id, text)``; ids are 32-bit."""
    with open(model_path, "rb") as f:  # a vocabulary file on the driver, a few hundred KB
        model = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Transducer.of_worker(model_path, model.value)
        for batch in batches:
            for part in slices(batch, "text"):
                ids = [None if t is None else machine.encode(t) for t in part.column("text").to_pylist()]
                back = [None if i is None else machine.decode(np.frombuffer(i, "<u4")) for i in ids]
                out = {
                    "doc_id": part.column("doc_id"),
                    "n_ids": pa.array([None if i is None else len(i) // 4 for i in ids], pa.int64()),
                    "ids_crc32": pa.array([None if i is None else zlib.crc32(i) for i in ids], pa.int64()),
                    "decoded": pa.array(back, pa.string()),
                }
                yield pa.RecordBatch.from_pydict(out | ({"ids": pa.array(ids, pa.binary())} if keep_ids else {}))

    schema = "doc_id long, n_ids long, ids_crc32 long, decoded string" + (", ids binary" if keep_ids else "")
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def piece_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op4_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's number of ids, CRC-32 of its ids, and the decoded text's size and digest."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return encode_texts(docs, piece_bpe_path(), keep_ids=False).select(
        "doc_id", "n_ids", "ids_crc32", F.octet_length("decoded").cast("long").alias("decoded_bytes"),
        F.md5("decoded").alias("decoded_md5"),
    )
