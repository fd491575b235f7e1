"""Packing of tokenised documents into fixed windows by minimum bin slack."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long"
_ENCODERS: dict[str, object] = {}
_WHOLE: dict[str, object] = {}


def encoder(path: str):
    """The byte-level BPE of a ``tokenizers`` file, run by ``tiktoken``: the same ids, several times as fast.

    Ids of a byte-level BPE are in merge order, so the ranks are the ids, and the
    file's added tokens become special tokens, as ``tokenizers`` treats them.
    """
    if path not in _ENCODERS:
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        to_byte = {chr(b): b for b in printable}
        to_byte |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in to_byte.values())}
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        ranks = {bytes(to_byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        _ENCODERS[path] = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
    return _ENCODERS[path]


_BLANK_RUN = re.compile(r"\s{100,}")
LONGEST_RUN = 10_000


def has_long_run(text: str) -> bool:
    """Whether characters other than white space, or white space, run on beyond ``LONGEST_RUN``."""
    if len(text) <= LONGEST_RUN:
        return False
    return max(map(len, text.split()), default=0) > LONGEST_RUN or any(m.end() - m.start() > LONGEST_RUN for m in _BLANK_RUN.finditer(text))


def encode(path: str, text: str) -> np.ndarray:
    """The ids that ``tokenizers`` gives a text of any length, special tokens of its own not added.

    ``tiktoken`` matches its pattern by backtracking, whose stack ends in runs of
    about a million blanks; texts with long runs go to ``tokenizers`` itself.
    """
    if not has_long_run(text):
        return np.asarray(encoder(path).encode_to_numpy(text, allowed_special="all"), dtype="<u4")
    if path not in _WHOLE:
        from tokenizers import Tokenizer

        _WHOLE[path] = Tokenizer.from_file(path)
    return np.asarray(_WHOLE[path].encode(text, add_special_tokens=False).ids, dtype="<u4")


def best_fill(counts: dict[int, int], lengths: list[int], capacity: int) -> dict[int, int]:
    """Counts of the lengths whose sum is the largest one up to ``capacity``.

    Subset-sum dynamic programming over an integer's bits, one step for each
    power-of-two share of a length's count; the steps are walked back for the
    counts.  ``lengths`` are tried in their order, until ``capacity`` is reached.
    """
    mask, reach, steps = (1 << (capacity + 1)) - 1, 1, []
    for length in lengths:
        left, share = min(counts[length], capacity // length), 1
        while left > 0:
            take = min(share, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left -= take
            share *= 2
        if reach >> capacity & 1:
            break
    at, used = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            used[length] = used.get(length, 0) + take
            at -= length * take
    return used


class Packer:
    """Packs one partition, a block at a time; what no full window takes goes to the next block."""

    def __init__(self, capacity: int, first_sequence: int, block_tokens: int):
        self.capacity, self.sequence, self.block_tokens = capacity, first_sequence, block_tokens
        self.tails: dict[int, list] = {}
        self.held, self.rows = 0, [[] for _ in range(8)]

    def _emit(self, pieces: list) -> None:
        total = sum(len(x[2]) for x in pieces)
        offset = 0
        for doc_id, start, ids, doc_tokens in pieces:
            row = (doc_id, start, len(ids), zlib.crc32(ids), doc_tokens, self.sequence, offset, total)
            for column, value in zip(self.rows, row, strict=True):
                column.append(value)
            offset += len(ids)
        self.sequence += 1

    def _keep(self, piece: tuple) -> None:
        self.tails.setdefault(len(piece[2]), []).append(piece)
        self.held += len(piece[2])

    def _take(self, length: int) -> tuple:
        pieces = self.tails[length]
        piece = pieces.pop()
        if not pieces:
            del self.tails[length]
        self.held -= length
        return piece

    def add(self, doc_id: int, ids: np.ndarray) -> None:
        n, c = len(ids), self.capacity
        for start in range(0, n - n % c, c):
            self._emit([(doc_id, start, ids[start : start + c], n)])
        if n % c:
            self._keep((doc_id, n - n % c, ids[n - n % c :].copy(), n))
        if self.held >= self.block_tokens:
            self.pack(False)
            if self.held >= self.block_tokens // 2:  # lengths that fill no window: cut them
                self.pack(True)

    def pack(self, final: bool) -> None:
        """Fill windows, each with the longest tail left and the multiset that comes closest to its capacity.

        A slack that no multiset closes is filled with a piece cut from the
        longest tail left.  The last window of a partition, which nothing can
        fill, is dealt into powers of two, which need no padding.
        """
        lengths, parked = sorted(self.tails, reverse=True), []
        while self.tails:
            lengths = [x for x in lengths if x in self.tails]
            longest = lengths[0]
            pieces = [self._take(longest)]
            room = self.capacity - longest
            counts = {x: len(p) for x, p in self.tails.items()}
            used = best_fill(counts, [x for x in lengths if x in counts and x <= room], room)
            slack = room - sum(x * k for x, k in used.items())
            if slack and not final:
                parked.append(pieces[0])
                continue
            for length, k in used.items():
                pieces += [self._take(length) for _ in range(k)]
            if slack and self.tails:
                doc_id, start, ids, n = self._take(max(self.tails))
                pieces.append((doc_id, start, ids[:slack], n))
                self._keep((doc_id, start + slack, ids[slack:], n))
                lengths = sorted(self.tails, reverse=True)
            elif slack:
                self._spread(pieces)
                continue
            self._emit(pieces)
        for piece in parked:
            self._keep(piece)

    def _spread(self, pieces: list) -> None:
        left = sum(len(x[2]) for x in pieces)
        while left:
            size = 1 << (left.bit_length() - 1)
            left -= size
            part, room = [], size
            while room:
                doc_id, start, ids, n = pieces.pop(0)
                part.append((doc_id, start, ids[:room], n))
                if len(ids) > room:
                    pieces.insert(0, (doc_id, start + room, ids[room:], n))
                room -= min(room, len(ids))
            self._emit(part)

    def flush(self) -> pa.RecordBatch:
        types = [pa.int64()] * 8
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(self.rows, types, strict=True)], names=names)
        self.rows = [[] for _ in range(8)]
        return out


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pack(docs: DataFrame, capacity: int = 1024, tokenizer_path: str | None = None, end_id: int = 0, block_tokens: int = 1 << 21) -> DataFrame:
    """Pack all documents into sequences of ``capacity`` tokens; one row for each piece.

    Every partition packs its own documents, in blocks of ``block_tokens``, with
    no shuffle: a sequence's number is its partition's number and its place
    there, so that a task that runs again gives the same rows.  Null and empty
    texts are the end token alone; an empty table gives no rows; repeated rows
    are packed each; extra columns are not read.  A document of any length is
    cut into full windows, its tail is packed with other tails.
    """
    path = tokenizer_path or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(capacity, TaskContext.get().partitionId() << 36, block_tokens)
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = encode(path, text.as_py() or "")
                packer.add(doc_id.as_py(), np.append(ids, np.array([end_id], "<u4")))
                if len(packer.rows[0]) >= 20_000:
                    yield packer.flush()
        packer.pack(False)
        packer.pack(True)
        yield packer.flush()

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
