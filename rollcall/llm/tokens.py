"""SentencePiece encoding and decoding through tables of distinct chunks."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from rollcall.llm.common import texts

MARK = "▁"
#: distinct chunks that a task keeps; a full table starts anew, which costs time but changes no result
TABLE_CHUNKS = 150_000


@lru_cache(maxsize=4)
def processor(path: str):
    """The model, once for each worker.  Raises where a piece could cross from one marked word into the next."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    for i in range(model.vocab_size()):
        if MARK in model.id_to_piece(i).lstrip(MARK):
            raise ValueError(f"piece {i} crosses a word marker; distinct chunks don't apply to this model")
    if model.decode(model.encode("  a \n\tb  ")) != "  a \n\tb  ":
        raise ValueError("this model rewrites white space; distinct chunks don't apply to it")
    return model


def chunks(text: str) -> list[str]:
    """The marked words of a text, each without its first marker.

    A chunk is a run of markers and what follows up to the next marker.  The model puts one
    marker before a text that isn't empty, and takes a space as a marker.
    """
    if not text:
        return []
    marked = text.replace(" ", MARK)
    if MARK * 2 not in marked and marked[0] != MARK:
        return marked.split(MARK)
    return [c[1:] for c in re.findall(f"{MARK}+[^{MARK}]*", MARK + marked)]


class ChunkTable:
    """Distinct chunks, their ids and decoded texts; each chunk is segmented once."""

    def __init__(self, path: str) -> None:
        self.model = processor(path)
        self.alone = self.model.encode("a ")[len(self.model.encode("a")):]
        self.anchor = self.model.encode("a")
        self.clear()

    def clear(self) -> None:
        self.places: dict[str, int] = {}
        self.ids: list[list[int]] = []
        self.spoken: list[str] = []

    def add(self, new: list[str]) -> None:
        # the model marks the start of a text by itself; a chunk of one marker has to be told apart from no text
        segments = self.model.encode(new, num_threads=1)
        segments = [s if c else self.alone for c, s in zip(new, segments)]
        decoded = self.model.decode([self.anchor + s for s in segments], num_threads=1)
        for chunk, segment, said in zip(new, segments, decoded):
            self.places[chunk] = len(self.ids)
            self.ids.append(segment)
            self.spoken.append(said[1:])

    def lookup(self, texts: list[str]) -> tuple[pa.Array, pa.Array]:
        """Ids and decoded text of every text, joined back from the table by position."""
        split = [chunks(t) for t in texts]
        if len(self.ids) > TABLE_CHUNKS:
            self.clear()
        known = self.places
        if new := list(dict.fromkeys(c for s in split for c in s if c not in known)):
            self.add(new)
        counts = np.fromiter(map(len, split), np.int64, len(split))
        place = np.fromiter((known[c] for s in split for c in s), np.int64, int(counts.sum()))
        lengths = np.fromiter(map(len, self.ids), np.int64, len(self.ids))
        flat = np.fromiter((i for s in self.ids for i in s), np.int32, int(lengths.sum()))
        starts = np.concatenate([[0], np.cumsum(lengths)])[:-1] if len(lengths) else lengths
        took = lengths[place]
        ends = np.cumsum(took)
        ids = flat[np.repeat(starts[place] - (ends - took), took) + np.arange(int(ends[-1]) if len(ends) else 0)]
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        said = self.spoken
        spoken = ["".join([said[known[c]] for c in s])[1:] for s in split]
        return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32())), pa.array(spoken, pa.string())


def encode_decode(docs: DataFrame, model_path: str, batch_chars: int = 2_000_000) -> DataFrame:
    """Every text as ids and back: ``doc_id, ids array<int>, decoded``.

    ``model_path`` is a place that every executor has.  Pieces that cannot cross a word marker
    make marked words independent of each other, so each task keeps a table of the distinct
    ones, asks the model once for each, and joins ids and decoded words back by position.
    Nothing is shuffled; a task holds one part of a batch and a table of bounded size.

    Equal to ``encode`` and ``decode(ids)`` of the library on the whole text, without begin or
    end ids.  A null or empty text has no ids and decodes to an empty text; a space or a marker
    character in the text decodes to a space, as the library does it.  Rows with equal or null
    ids all stay; other columns go.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ChunkTable(model_path)
        for batch in batches:
            ids, rows = batch.column(0), batch.column(1)
            lengths = pc.binary_length(rows).to_pylist()
            start = 0
            while start < len(rows):
                end, size = start, 0
                while end < len(rows) and (end == start or size + lengths[end] <= batch_chars):
                    size += lengths[end]
                    end += 1
                encoded, decoded = table.lookup(rows.slice(start, end - start).to_pylist())
                yield pa.RecordBatch.from_arrays([ids.slice(start, end - start), encoded, decoded], ["doc_id", "ids", "decoded"])
                start = end

    rows = texts(docs, "doc_id")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(encode, f"doc_id {kind}, ids array<int>, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """Number of ids and digests of ids and decoded text."""
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
                          F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_sentencepiece(docs: DataFrame) -> DataFrame:
    return digests(encode_decode(docs, model_path()))
