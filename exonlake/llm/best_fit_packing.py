"""Best-fit packing of tokenised documents by hierarchical residual merging.

Every task tokenises its documents, cuts those longer than a sequence, and
best-fits its own pieces, longest first.  Full and nearly full bins are done;
underfull bins go up a tree as items: nodes of ``FAN`` children best-fit them
again, pass what stays underfull on, and after the last round whatever is left
is a sequence as it is.  All underfull bins go up; a node with more than
``NODE_BINS`` is dealt out by hash to as many as it needs, so none grows with the
corpus.

Token ids come from the public tokenizer file whose path is a parameter.  The
tokenizer splits at white space, so words are encoded once per worker and reused
(ASCII letters are lowered first, as the tokenizer does itself); a word of letters
followed by ASCII marks is encoded as its two parts.

Defined cases: a null or empty text is one piece of the end token alone; repeated
rows are packed each for itself, as are ties; a null doc_id keeps its pieces, with
a null doc_id; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import textops as tx
from .store import written

#: Free tokens up to which a bin counts as nearly full.
SLACK = 16
FAN = 8
#: Underfull bins that a node of the tree merges, about.
NODE_BINS = 20_000
#: Words whose ids a worker keeps; then it begins anew, and those of the last round that are met again are taken over.
MAX_WORDS = 300_000
#: Bytes of texts whose new words are learned together.
GROUP_BYTES = 1 << 18
_PARTS = re.compile(rb"([a-z\x80-\xff]+)([!-&(-/:-;=-@\[-`{-~]+)")
_encoders: dict[str, WordEncoder] = {}


class WordEncoder:
    """Ids of texts as little-endian uint32 bytes, by the words that white space parts."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}
        (self.digit,) = self.tokenizer.encode("0", add_special_tokens=False).ids

    def whole(self, word: bytes) -> bytes:
        ids = self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def part(self, word: bytes) -> bytes:
        got = self.known.get(word)
        if got is None:
            got = self.known[word] = self.whole(word)
        return got

    def word(self, word: bytes) -> bytes:
        parts = _PARTS.fullmatch(word)
        if parts and parts[1].decode("utf-8", "replace")[-1].isalpha():
            return self.part(parts[1]) + self.part(parts[2])
        return self.whole(word)

    def plain(self, words: list[bytes]) -> None:
        """Learn words of letters alone at once, with a digit between them: a token that no letters give."""
        if not words:
            return
        got = self.tokenizer.encode_batch_fast([b" 0 ".join(words).decode()], add_special_tokens=False)[0].ids
        ids = np.array(got, "<u4")
        cuts, data = np.flatnonzero(ids == self.digit), ids.tobytes()
        starts, ends = [0, *(4 * cuts + 4).tolist()], [*(4 * cuts).tolist(), len(data)]
        self.known.update((w, data[s:e]) for w, s, e in zip(words, starts, ends, strict=True))

    def learn(self, words: list[bytes]) -> None:
        """Words of letters, and those with ASCII marks behind, by their letters; others one by one."""
        plain, marked = {}, []
        for word in words:
            if word.isalpha():  # ASCII letters alone, as most are
                plain[word] = None
                continue
            parts = _PARTS.fullmatch(word)
            letters = parts[1] if parts else word
            if not letters.decode("utf-8", "replace").isalpha():
                self.known[word] = self.word(word)
                continue
            if letters not in self.known:
                plain[letters] = None
            if parts:
                marked.append((word, letters, parts[2]))
        self.plain(list(plain))
        for word, letters, marks in marked:
            self.known[word] = self.known[letters] + self.part(marks)

    def ids(self, text: bytes) -> bytes:
        return self.all_ids([text])[0]

    def all_ids(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text; words that are new in any are learned at once."""
        # "<|" could name a special token, which is told by its case
        split = [None if b"<|" in t else t.lower().replace(b"\n", b" ").split(b" ") for t in texts]
        if len(self.known) > MAX_WORDS:
            self.before, self.known = self.known, {}
        known, before = self.known, self.before
        new = set().union(*(w for w in split if w is not None)).difference(known)
        again = [w for w in new if w in before]
        known.update(zip(again, map(before.__getitem__, again)))
        self.learn(list(new.difference(again)))
        return [self.whole(t) if words is None else b"".join(map(known.__getitem__, words)) for t, words in zip(texts, split, strict=True)]


def encoder(path: str) -> WordEncoder:
    """One encoder per worker and file."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def encoded(enc: WordEncoder, texts: pa.Array) -> Iterator[bytes]:
    """Ids of each text, some texts of GROUP_BYTES together at a time."""
    held, size = [], 0
    for text in texts:
        held.append(text.as_py() or b"")
        size += len(held[-1])
        if size >= GROUP_BYTES:
            yield from enc.all_ids(held)
            held, size = [], 0
    yield from enc.all_ids(held)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best fit, longest first: the bin and place of every item, and each bin's fill."""
    bins, places, fills = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), []
    free: list[tuple[int, int]] = []
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        at = bisect_left(free, (size, -1))
        if at == len(free):
            fills.append(size)
            left, b = capacity - size, len(fills) - 1
        else:
            left, b = free.pop(at)
            places[i] = fills[b]
            fills[b] += size
            left -= size
        bins[i] = b
        if left:
            insort(free, (left, b))
    return bins, places, np.array(fills, np.int64)


def tokenised(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32), each with its task's bin and place, and that bin's fill."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, enc = TaskContext.get().partitionId(), encoder(tokenizer_path)
        doc, piece, start, length, crc = [], [], [], [], []
        for batch in tx.chunks(batches):
            texts = batch.column("text").cast(pa.large_binary())
            for doc_id, found in zip(batch.column("doc_id").to_pylist(), encoded(enc, texts), strict=True):
                ids = memoryview(found + end)
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    doc.append(doc_id)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
        if doc:
            bins, places, fills = best_fit(np.array(length, np.int64), capacity)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array((np.int64(task) << 32) + bins), pa.array(places), pa.array(fills[bins])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "bin", "place", "fill"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, place long, fill long")


def _merged(bins: DataFrame, capacity: int) -> DataFrame:
    """(bin, into, at, fill) of each node's bins after another best fit."""

    def run(table: pa.Table) -> pa.Table:
        ids, fill = table.column("bin").to_numpy(), table.column("fill").to_numpy()
        order = np.argsort(ids)
        ids, fill = ids[order], fill[order]
        own, places, fills = best_fit(fill, capacity)
        first = np.zeros(len(fills), np.int64)
        first[own[places == 0]] = ids[places == 0]  # a bin goes by its first part
        return pa.table({"bin": ids, "into": first[own], "at": places, "fill": fills[own]})

    return bins.groupBy("node").applyInArrow(run, "bin long, into long, at long, fill long")


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = 4096, slack: int = SLACK) -> DataFrame:
    """Every piece with its sequence_id and its offset there."""
    pieces = written(tokenised(docs, tokenizer_path, end_id, capacity), "op6-pieces")
    bins = pieces.select("bin", "fill").distinct().where(F.col("fill") < capacity - slack)
    nodes = pieces.agg(F.max(F.shiftright("bin", 32))).first()[0]
    nodes, moves, width = 1 if nodes is None else nodes + 1, None, 1
    while True:
        width *= FAN
        bins = bins.withColumn("_node", F.floor(F.shiftright("bin", 32) / width))
        parts = F.broadcast(bins.groupBy("_node").agg(F.ceil(F.count("*") / NODE_BINS).alias("_parts")))  # a row for FAN tasks or more
        bins = bins.join(parts, "_node").select(F.struct("_node", F.pmod(F.xxhash64("bin"), F.col("_parts")).alias("part")).alias("node"), "bin", "fill")
        step = written(_merged(bins, capacity), "op6-merge")
        if moves is None:
            moves = step.select("bin", "into", "at")
        else:
            later = step.select(F.col("bin").alias("into"), F.col("into").alias("_into"), F.col("at").alias("_at"))
            moves = moves.join(later, "into", "left").select("bin", F.coalesce("_into", "into").alias("into"), (F.col("at") + F.coalesce("_at", F.lit(0))).alias("at"))
        bins = step.where(F.col("fill") < capacity - slack).select(F.col("into").alias("bin"), "fill").distinct()
        if width >= nodes:
            break
    placed = pieces.join(written(moves, "op6-moves"), "bin", "left")
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", F.coalesce("into", "bin").alias("sequence_id"), (F.col("place") + F.coalesce("at", F.lit(0))).alias("offset"))

