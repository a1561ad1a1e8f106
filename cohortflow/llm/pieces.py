"""Operator 5, SentencePiece encoding and decoding: a merge-type prefix table.

BPE by scores has this property: of all pieces that end where a prefix of the text ends, exactly one is the
last token of that prefix's encoding. It is the piece that goes together with the last token of the prefix
before it. So one pass over the matches of an automaton of all pieces stores the last token of each prefix,
and a walk backwards from the end reads the ids. Two tokens go together if no merge across their seam would
have come before the merges that made them.

Texts are cut where no merge can reach across: between two characters that no piece holds side by side. Equal
parts are then encoded once for each worker, in a store of ``KEPT`` bytes that lives until a task of another operator
takes the worker. Each part is kept with its ids and with the text decoded from these; as no byte of a character is in
another part, the decoded texts of the parts, one after the other, are the text decoded from all ids.

Defined results: null text counts as empty; an empty text has no ids, the digest of the empty text, and
decodes to the empty text; characters without a piece become their UTF-8 bytes; U+2581 in a text encodes as a
space and so decodes to one; ids may be null or repeated; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from collections.abc import Iterable, Iterator
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.llm.common import hold, ship, slices, text_of

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Bytes that a worker's store may take, as far as they can be estimated, and pairs of tokens that it keeps.
KEPT, PAIRS = 112 << 20, 400_000
OUT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        number, kind = divmod(varint(), 8)
        if kind == 0:
            yield number, varint()
        else:
            n = {1: 8, 5: 4}.get(kind) or varint()
            yield number, data[at:at + n]
            at += n


def read_model(data: bytes) -> list[tuple[str, float, int]]:
    """Piece, score and type by id. Only models whose text handling this module follows are taken."""
    pieces, normaliser, trainer = [], {}, {}
    for number, value in _fields(data):
        if number == 1:
            f = dict(_fields(value))
            pieces.append((f[1].decode(), struct.unpack("<f", f[2])[0] if 2 in f else 0.0, f.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(_fields(value))
        elif number == 3:
            normaliser = dict(_fields(value))
    kinds = {k for _, _, k in pieces}
    fits = (trainer.get(3) == 2 and trainer.get(35) == 1 and not trainer.get(24) and not normaliser.get(2)  # BPE, byte fallback
            and normaliser.get(3, 1) == 1 and normaliser.get(4, 1) == 0 and normaliser.get(5, 1) == 1  # only the space before the text
            and not kinds & {USER_DEFINED, UNUSED})
    if not fits:
        raise ValueError("only BPE models with byte fallback, no normalisation and no user-defined pieces are supported")
    return pieces


class PrefixTable:
    """Encoder and decoder of one model."""

    def __init__(self, pieces: list[tuple[str, float, int]]):
        import ahocorasick

        self.piece = [p for p, _, _ in pieces]
        self.byte = {int(p[3:5], 16): i for i, (p, _, k) in enumerate(pieces) if k == BYTE}
        self.byte_of = {i: b for b, i in self.byte.items()}
        self.id = {p: i for i, (p, _, k) in enumerate(pieces) if k == NORMAL}
        better = {s: r for r, s in enumerate(sorted({s for _, s, k in pieces if k == NORMAL}, reverse=True))}
        self.rank = {p: better[pieces[i][1]] for p, i in self.id.items()}  # the smaller merges first
        self.halves: dict[str, tuple[str, str]] = {}
        self.automaton = ahocorasick.Automaton()
        for p in sorted(self.id, key=len):
            if self._made(p):
                self.automaton.add_word(p, self.id[p])
        self.automaton.make_automaton()
        self.sizes = [len(p) for p in self.piece]
        self._fit: dict[int, bool] = {}
        self.kept: int | None = None

    def _made(self, piece: str) -> bool:
        """Whether merging makes the piece of its characters; notes its last merge."""
        parts = list(piece)
        while len(parts) > 1:
            at = min(range(len(parts) - 1), key=lambda i: (self.rank.get(parts[i] + parts[i + 1], 1 << 60), i))
            if parts[at] + parts[at + 1] not in self.rank:
                return False
            if len(parts) == 2:
                self.halves[piece] = (parts[0], parts[1])
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return True

    def _go_together(self, left: str, right: str) -> bool:
        """Takes back the merges beside the seam, the latest first, and looks whether one across it came earlier."""
        rank, halves, limit = self.rank, self.halves, (1 << 60, 0)
        while True:
            # of equal ranks the merge further left comes first: the left token's (0), across (1), the right token's (2)
            if (across := rank.get(left + right)) is not None and (across, 1) < limit:
                return False
            last = max(((rank[left], 0) if left in halves else (-1, 0)), ((rank[right], 2) if right in halves else (-1, 0)))
            if last[0] < 0:
                return True
            limit = last
            if last[1]:
                right = halves[right][0]
            else:
                left = halves[left][1]

    def ids(self, part: str) -> list[int]:
        """The ids of a text that has U+2581 for spaces."""
        last = [-1] * len(part)  # the last token of each prefix; -1 for a character without piece, which goes with any token
        fit, sizes, pairs = self._fit, self.sizes, PAIRS * self.room // KEPT
        for end, token in self.automaton.iter(part):
            if last[end] >= 0:
                continue
            start = end - sizes[token]
            if start >= 0 and (before := last[start]) >= 0:
                if (ok := fit.get(pair := before << 20 | token)) is None:
                    if len(fit) >= pairs:
                        fit.clear()
                    ok = fit[pair] = self._go_together(self.piece[before], self.piece[token])
                if not ok:
                    continue
            last[end] = token
        out, at = [], len(part) - 1
        while at >= 0:
            if (token := last[at]) >= 0:
                out.append(token)
                at -= sizes[token]
            else:
                out += [self.byte[b] for b in reversed(part[at].encode())]
                at -= 1
        return out[::-1]

    def text(self, ids: Iterable[int]) -> str:
        """The text of ids, with the space that encoding puts before it."""
        out, held = [], bytearray()
        for i in ids:
            if (b := self.byte_of.get(i)) is not None:
                held.append(b)
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held.clear()
            out.append(self.piece[i])
        out.append(held.decode("utf-8", "replace"))
        return "".join(out).replace(SPACE, " ")

    def decode(self, ids: Iterable[int]) -> str:
        """As the library: without the space that encoding put before the text."""
        return self.text(ids).removeprefix(" ")

    def encode(self, text: str) -> list[int]:
        return [int(x) for x in self.digestible(text)[0].split(",")] if text else []

    def digestible(self, text: str) -> tuple[str, str]:
        """The ids joined by commas, and the text decoded from them."""
        if not text:
            return "", ""
        known, found = self.known, []
        for n, line in enumerate(text.split("\n")):  # no piece holds a line feed, or a character before a space
            if n:
                found.append(known["\n"])
            if SPACE in line or "  " in line or line[:1] == " " or line[-1:] == " " or not line:
                parts = _PARTS.findall((" " * (not n) + line).replace(" ", SPACE))
            else:
                parts = (line if n else " " + line).replace(" ", _CUT).split("\n")
                if not n:
                    del parts[0]
            found += map(known.__getitem__, parts)
        return ",".join([ids for ids, _ in found]), "".join([back for _, back in found]).removeprefix(" ")

    @property
    def room(self) -> int:
        return KEPT if self.kept is None else self.kept

    def keep(self, kept: int | None) -> None:
        """Bounds the store (None: by ``KEPT``), and the pairs in proportion; a store of another bound is freed."""
        if kept != self.kept:
            self.forget()
            self.kept = kept

    def forget(self) -> None:
        """Frees what has been kept."""
        self.__dict__.pop("_known", None)
        self._fit.clear()

    @property
    def known(self) -> _Known:
        if "_known" not in self.__dict__:
            if any("\n" in p or re.search(f"[^{SPACE}]{SPACE}", p) for p in self.id):
                raise ValueError("a piece reaches across the end of a word or line")
            self._known = _Known(self)
        return self._known


_PARTS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_CUT = "\n" + SPACE


class _Known(dict):
    """The joined ids of parts and the text that they decode to; made where missing.

    When half of the bytes are taken, the parts become the old generation, and those of the one before can go.
    """

    def __init__(self, table: PrefixTable):
        super().__init__()
        self.table, self.old, self.bytes = table, {}, 0

    def __missing__(self, part: str) -> tuple[str, str]:
        if (found := self.old.get(part)) is None:
            ids = self.table.ids(part)
            found = ",".join(map(str, ids)), self.table.text(ids)
        if len(part) <= 64:
            self.bytes += 300 + 3 * len(part) + len(found[0])
            if 2 * self.bytes >= self.table.room:
                self.old, self.bytes = dict(self), 0
                self.clear()
            self[part] = found
        return found


@cache
def _table(model: bytes) -> PrefixTable:
    return PrefixTable(read_model(model))


def tokenizer_model() -> str:
    """The tokenizer's model file; TOKENIZER_MODEL names another place."""
    if path := os.environ.get("TOKENIZER_MODEL"):
        return path
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def load(spark: SparkSession, path: str) -> bytes:
    """The model file (some hundred KB), from any place that the driver or Spark can read."""
    try:
        with open(path, "rb") as f:
            return f.read()
    except FileNotFoundError:
        return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


def encode_decode(docs: DataFrame, model_path: str, kept: int | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each document's whole text.

    ``kept`` bounds a worker's store where other work has filled the executor's memory (None: ``KEPT``)."""
    spark = docs.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast(load(spark, model_path))

    def digests(batches):
        import pyarrow as pa

        table = _table(model.value)
        table.keep(kept)
        hold("pieces", table.forget)
        for batch in slices(batches, name="pieces"):
            counts, ids, texts = [], [], []
            for text in batch.column(1).to_pylist():
                joined, back = table.digestible(text)
                counts.append(joined.count(",") + 1 if joined else 0)
                ids.append(hashlib.sha256(joined.encode()).hexdigest())
                texts.append(hashlib.sha256(back.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(digests, OUT)


def encode_ids(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id and ids (array of int) of each document."""
    spark = docs.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast(load(spark, model_path))

    def encoded(batches):
        import pyarrow as pa

        table = _table(model.value)
        table.keep(None)
        hold("pieces", table.forget)
        for batch in slices(batches, name="pieces"):
            ids = pa.array([table.encode(t) for t in batch.column(1).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(encoded, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")
