"""SentencePiece encoding by backtracking over longest matches, and decoding.

The ids are those of merging pairs of symbols, best score first and leftmost among
equals.  Merges that cross no boundary of a segment come in the same order in the
segment alone, so a sequence of pieces is the result of merging exactly if merging
the text of each two neighbours gives those two again.  Such a sequence is sought
from the left, with the longest piece first; since the sequence of each prefix is
the only one, a position from which nothing leads on fails for good.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytoframe.llm.arrow_text import parts

SPACE = "▁"
#: Bounds of what a worker keeps: chunks of up to so many characters, so many of them, and so many pairs of pieces.
CHUNK_CHARACTERS, CHUNKS_KEPT, PAIRS_KEPT = 48, 1 << 20, 1 << 19
#: Marks before which a chunk ends where they follow a letter, as far as no piece of the model has a letter before them.
MARKS = ".,;:!?"
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_ONE = (1,)
_ENCODERS: dict[str, PieceEncoder] = {}


class PieceEncoder:
    """The BPE of a SentencePiece model with byte fallback, whose pieces are plain ones."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        self.bytes = [self.model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(self.model.is_byte(i) for i in self.bytes) or any(self.model.is_unused(i) for i in range(size)):
            raise ValueError("the model has to have a piece for each byte, and no unused pieces")
        plain = [i for i in range(size) if not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i))]
        self.ids = {self.model.id_to_piece(i): i for i in plain}
        self.scores = {p: self.model.get_score(i) for p, i in self.ids.items()}
        self.longest = max(map(len, self.ids))
        # Each piece stands for the lengths of all pieces that begin as it does, itself first, and of its first character.
        self.matches = ahocorasick.Automaton()
        for p in self.ids:
            self.matches.add_word(p, (*[k for k in range(len(p), 1, -1) if p[:k] in self.ids], 1))
        self.matches.make_automaton()
        self.chunk = re.compile(self._chunk_pattern())
        self.chunks: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[tuple[str, str], bool] = {}

    def _chunk_pattern(self) -> str:
        """Cuts only where no piece of the model lies across: what is cut there is merged on each side alone.

        Before spaces that follow anything else, around line ends, and between
        letters and those marks that no piece has after a letter.
        """
        joined = {(a, b) for p in self.ids for a, b in zip(p, p[1:], strict=False)}
        if any(b == SPACE != a for a, b in joined):
            return "(?s:.+)"
        ends = "" if any("\n" in pair for pair in joined) else "\n"
        rest = f"{SPACE}+[^{SPACE}{ends}]*|[^{SPACE}{ends}]+|\n"
        marks = re.escape("".join(m for m in MARKS if not any(b == m and a.isalpha() for a, b in joined)))
        return f"{SPACE}*[^{SPACE}{ends}]*?[{LETTERS}](?=[{marks}])|{rest}" if marks else rest

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text by merging the best pair, the leftmost of equals, again and again."""
        pieces, scores = list(text), self.scores
        while True:
            best, at = None, -1
            for i in range(len(pieces) - 1):
                pair = pieces[i] + pieces[i + 1]
                if pair in scores and (best is None or scores[pair] > best):
                    best, at = scores[pair], i
            if best is None:
                return pieces
            pieces[at : at + 2] = [pieces[at] + pieces[at + 1]]

    def compatible(self, left: str, right: str) -> bool:
        """Whether merging the text of both gives both; ``left`` is empty at the start of a text."""
        fits = self.merged(left + right) == ([left, right] if left else [right])
        if len(self.pairs) >= PAIRS_KEPT:
            self.pairs.clear()
        self.pairs[left, right] = fits
        return fits

    def lengths_at(self, text: str, at: int) -> tuple[int, ...]:
        """The lengths of the pieces that begin at a place, the longest first; one character may be no piece."""
        for end, lengths in self.matches.iter_long(text[at : at + self.longest]):
            return lengths if end + 1 == lengths[0] else _ONE
        return _ONE

    def sizes(self, text: str) -> bytearray:
        """The lengths of a normalised text's pieces; a character that is no piece is one of its own."""
        n, pairs, failed, taken = len(text), self.pairs, None, bytearray()
        at, left, below = 0, "", 256
        while at < n:
            for size in self.lengths_at(text, at):
                end = at + size
                if size >= below or failed is not None and failed[end >> 3] >> (end & 7) & 1:
                    continue
                piece = text[at:end]
                fits = pairs.get((left, piece))
                if self.compatible(left, piece) if fits is None else fits:
                    taken.append(size)
                    left, at, below = piece, end, 256
                    break
            else:
                if failed is None:
                    failed = bytearray(n // 8 + 1)
                failed[at >> 3] |= 1 << (at & 7)
                below = taken.pop()
                at -= below
                left = text[at - taken[-1] : at] if taken else ""
        return taken

    def of_chunk(self, text: str) -> list[int]:
        """The ids of a chunk; characters without a piece are their bytes.  Short chunks are kept."""
        found, at, ids = [], 0, self.ids
        for size in self.sizes(text):
            piece = text[at : at + size]
            at += size
            if piece in ids:
                found.append(ids[piece])
            else:
                found += [self.bytes[b] for b in piece.encode()]
        if len(text) <= CHUNK_CHARACTERS:
            if len(self.chunks) >= CHUNKS_KEPT:
                self.chunks.clear()
            self.chunks[text] = tuple(found)
        return found

    def encode(self, text: str) -> list[int]:
        """The ids of a text of any length, as the library's ``encode`` gives them."""
        known, new = self.chunks.get, self.of_chunk
        return list(chain.from_iterable([known(c) or new(c) for c in self.chunk.findall(self.model.normalize(text))]))

    def decode(self, ids: list[int]) -> str:
        return self.model.decode(ids)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encoder(path: str) -> PieceEncoder:
    """One encoder for each model and worker, so that chunks seen before are not encoded again."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def _mapped(df: DataFrame, columns: list[str], schema: str, kind: pa.DataType, change) -> DataFrame:
    """The first of the columns as it is, and ``change`` of the second's values, a few hundred at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, 256):
            keys = batch.column(0)
            yield pa.RecordBatch.from_arrays([keys, *change(batch.column(1), kind)], names=[c.split()[0] for c in schema.split(", ")])

    return df.select(*columns).mapInArrow(run, schema)


def encode_documents(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """One row for each document: doc_id, ids and the text that they decode to.

    The ids are those of the library's ``encode`` without begin and end ids.  Null
    and empty texts have no ids and decode to the empty text; texts of any length
    are encoded whole; repeated rows give a row each; other columns, of any name,
    are not read; an empty table gives none.  No row needs another, so there is no
    shuffle; a worker keeps a bounded number of chunks that it has encoded.
    """
    path = model_path or default_model()

    def change(texts: pa.Array, kind: pa.DataType) -> list[pa.Array]:
        e = encoder(path)
        ids = [e.encode(t or "") for t in texts.to_pylist()]
        return [pa.array(ids, kind), pa.array([e.decode(x) for x in ids], pa.string())]

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return _mapped(docs, ["doc_id", "text"], f"doc_id {id_type}, ids array<int>, decoded string", pa.list_(pa.int32()), change)


def decode_documents(encoded: DataFrame, model_path: str | None = None) -> DataFrame:
    """One row for each row of ``encoded`` (doc_id, ids): doc_id and the text; null and empty ids are the empty text."""
    path = model_path or default_model()

    def change(ids: pa.Array, kind: pa.DataType) -> list[pa.Array]:
        return [pa.array([encoder(path).decode(x or []) for x in ids.to_pylist()], kind)]

    id_type = encoded.schema["doc_id"].dataType.simpleString()
    return _mapped(encoded, ["doc_id", "ids"], f"doc_id {id_type}, text string", pa.string(), change)


def _hex_digest(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids, joined by commas) and decoded_sha256 of `encode_documents`."""
    listed = F.array_join(F.transform("ids", lambda i: i.cast("string")), ",")
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), _hex_digest(listed).alias("ids_sha256"), _hex_digest(F.col("decoded")).alias("decoded_sha256"))
