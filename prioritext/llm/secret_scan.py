"""Secret scan: keyword automaton, anchored expressions near its hits, checksums inside the find.

1. An Aho-Corasick automaton runs once over each whole text (letters A-Z
   lowered) and finds every keyword; a second one finds stretches of ``32``
   hexadecimal digits, over a view of the text in which every such digit is
   one symbol.
2. Only at a hit the kind's expression is tried, anchored there.  Hits are
   taken from left to right; one that begins inside an earlier match of its
   kind is skipped, so the matches are the leftmost non-overlapping ones of
   the whole text.
3. Kinds that carry a checksum are kept only where it holds: CRC-32 in base
   62 at the end of repository and package tokens, the Luhn digit of a card
   number behind a card word, the remainder 1 modulo 97 of an account number.

Everything is one map over the documents: no row meets another.

Defined results
  null or empty text: no spans; null id: scanned like any other; repeated
  rows: a result row each; very long text: scanned whole; spans of different
  kinds may overlap, those of one kind don't; ties of start: order of
  ``KINDS``; empty table: empty result; extra columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prioritext.llm.tables import table
from prioritext.llm.words import slices

# fixed values: kinds, keywords, expressions and least lengths
HEX_LENGTH = 32
ASSIGN = rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = rb"AKIA[A-Z0-9]+"
HEX = rb"[0-9a-f]+"
TOKEN = rb"(?:gh[pousr]|npm)_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z_])"
CARD = rb"(?:card|visa)[^0-9\n]{0,24}((?:[0-9][\x20-]?){12,18}[0-9])(?![0-9])"
ACCOUNT = rb"iban[^0-9A-Za-z\n]{0,8}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})(?![A-Z0-9])"
BASE_62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def crc_holds(match: re.Match[bytes]) -> bool:
    """The last six characters are the CRC-32 of the thirty before, in base 62."""
    value = 0
    for digit in match[2]:
        value = value * 62 + BASE_62.index(digit)
    return value == zlib.crc32(match[1])


def luhn_holds(match: re.Match[bytes]) -> bool:
    digits = [d - 48 for d in match[1] if 48 <= d <= 57]
    doubled = [d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits))]
    return any(digits) and sum(doubled) % 10 == 0


def remainder_holds(match: re.Match[bytes]) -> bool:
    """An account number moved by four and read with A as 10, B as 11, leaves 1 modulo 97."""
    number = match[1].replace(b" ", b"").decode()
    return int("".join(str(int(c, 36)) for c in number[4:] + number[:4])) % 97 == 1


@dataclass(frozen=True)
class Kind:
    """A kind of secret; ``holds`` judges a match, ``group`` is the part of it that is the span."""

    name: str
    keywords: tuple[bytes, ...]
    expression: re.Pattern[bytes]
    holds: Callable[[re.Match[bytes]], bool]
    group: int = 0


BASE = (
    Kind(
        "assign",
        (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key"),
        re.compile(ASSIGN, re.IGNORECASE),
        lambda m: len(m[2]) >= 8,
    ),
    Kind("access", (b"akia",), re.compile(ACCESS), lambda m: len(m[0]) >= 16),
    Kind("hex", (), re.compile(HEX), lambda m: len(m[0]) >= HEX_LENGTH),
)
CHECKED = (
    Kind("vendor", (b"ghp_", b"gho_", b"ghu_", b"ghs_", b"ghr_", b"npm_"), re.compile(TOKEN), crc_holds),
    Kind("card", (b"card", b"visa"), re.compile(CARD, re.IGNORECASE), luhn_holds, 1),
    Kind("account", (b"iban",), re.compile(ACCOUNT.replace(b"iban", b"(?i:iban)")), remainder_holds, 1),
)
KINDS = BASE + CHECKED

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_HEX_CLASS = bytes(48 if chr(i) in "0123456789abcdef" else 32 for i in range(256))


class Scanner:
    """The automata of some kinds; made once a task."""

    def __init__(self, kinds: tuple[Kind, ...] = KINDS):
        self.kinds = kinds
        self.words = ahocorasick.Automaton()
        owners: dict[bytes, list[int]] = {}
        for number, kind in enumerate(kinds):
            for word in kind.keywords:
                owners.setdefault(word, []).append(number)
        for word, numbers in owners.items():
            self.words.add_word(word.decode("latin-1"), (len(word) - 1, tuple(numbers)))
        self.words.make_automaton()
        self.stretch = ahocorasick.Automaton()
        self.stretch.add_word("0" * HEX_LENGTH, HEX_LENGTH - 1)
        self.stretch.make_automaton()
        self.hex = next((n for n, k in enumerate(kinds) if not k.keywords), None)

    def hits(self, raw: bytes) -> list[tuple[int, int]]:
        """``(start, kind)`` of every keyword and the start of every stretch of digits, in order."""
        found = [
            (end - back, number)
            for end, (back, numbers) in self.words.iter(raw.translate(_LOWER).decode("latin-1"))
            for number in numbers
        ]
        if self.hex is not None:
            view = raw.translate(_HEX_CLASS).decode("latin-1")
            ahead = -2
            for end, back in self.stretch.iter(view):
                if end != ahead + 1:
                    found.append((end - back, self.hex))
                ahead = end
        found.sort()
        return found

    def spans(self, raw: bytes) -> list[tuple[int, int, int]]:
        """``(start, kind, end)`` of every secret in the text's UTF-8 bytes, in code points."""
        found, free = [], [0] * len(self.kinds)
        for start, number in self.hits(raw):
            if start < free[number]:
                continue
            kind = self.kinds[number]
            match = kind.expression.match(raw, start)
            if match is None:
                continue
            free[number] = match.end()
            if kind.holds(match):
                found.append((match.start(kind.group), number, match.end(kind.group)))
        found.sort()
        return found if raw.isascii() else _code_points(raw, found)


def _code_points(raw: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Byte offsets counted again in code points; each stretch between two starts is decoded once."""
    out, seen, at = [], 0, 0
    for start, number, end in spans:
        seen, at = seen + len(raw[at:start].decode()), start
        out.append((seen, number, seen + len(raw[start:end].decode())))
    return out


def find_secrets(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``secrets``: an array of ``(kind, start, end)`` in code points, ordered by start and kind.

    ``keep`` names the columns that stay (all by default), so that a scan need not send its texts back.
    """
    keep = [c for c in docs.columns if c != "secrets"] if keep is None else keep
    docs = docs.select(*dict.fromkeys([*keep, text_col]))
    schema = "array<struct<kind string, start long, end long>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        names = [k.name for k in scanner.kinds]
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            for part in slices(batch, text_col):
                rows = [
                    [(names[n], s, e) for s, n, e in scanner.spans(t.as_buffer().to_pybytes())] if t.is_valid else []
                    for t in part.column(text_col)
                ]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), pa.array(rows, pa.list_(kind))], names=[*keep, "secrets"]
                )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return docs.mapInArrow(run, f"{fields}, secrets {schema}")


def masked(docs: DataFrame, text_col: str = "text", mask: str = "*") -> DataFrame:
    """``docs`` with every secret's characters replaced by ``mask`` (one for each code point)."""
    found = find_secrets(docs, text_col)

    def cover(text, span):
        return F.concat(
            F.substring(text, F.lit(1), span["start"].cast("int")),
            F.repeat(F.lit(mask), (span["end"] - span["start"]).cast("int")),
            F.substring(text, (span["end"] + 1).cast("int"), F.length(text)),
        )

    return found.withColumn(text_col, F.aggregate("secrets", F.col(text_col), cover)).drop("secrets")


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of every document: counts and digest of the base kinds, spans of all."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    base = [k.name for k in BASE]
    found = find_secrets(docs, keep=["doc_id"])

    def count(name: str):
        return F.size(F.filter("secrets", lambda s: s["kind"] == name)).cast("long")

    def joined(spans):
        parts = F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        )
        return F.array_join(parts, ",")

    return found.select(
        "doc_id",
        *(count(name).alias(f"n_{name}") for name in base),
        F.sha2(joined(F.filter("secrets", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
        F.size("secrets").cast("long").alias("n_spans"),
    )
