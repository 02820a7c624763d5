"""SentencePiece encoding and decoding by a table of distinct chunks.

The library replaces each space by a marker and puts one before the text. Where no piece of the model has a marker after another
character, no piece crosses from a word to the next marker, so a marked word has the same ids wherever it stands: each
distinct one is segmented once and its ids are joined back by position. A model for which this does not hold, and a text
that holds the marker itself, is encoded whole.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagegrain.llm.common import ChunkTable, encoded, ended, filled, light, process_tables, ship, table

ship(__name__)

MODEL = "piece_bpe_32k.model"
MARKER = "▁"
#: The spaces before a word, and the word.
MARKED = re.compile(" +[^ ]*")
#: Texts with other than single spaces between words, or with the marker itself.
APART = f"^ | $|  |{MARKER}"
ENTRIES = 600_000


class PieceCodec:
    def __init__(self, path: str, entries: int = ENTRIES):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (self.library.id_to_piece(i) for i in range(self.library.get_piece_size()))
        self.apart = (not any(MARKER in p.lstrip(MARKER) for p in pieces)
                      and self.library.normalize("  A b\n ﬁ  ") == f"{MARKER * 3}A{MARKER}b\n ﬁ{MARKER * 2}")
        self.marker = packed([self.library.piece_to_id(MARKER)])
        self.end = self.library.eos_id()
        #: by word after one space: ids as 32-bit integers
        self.words = ChunkTable(lambda word: packed(self.library.encode(word, num_threads=1)), entries)
        #: by several spaces and a word
        self.marked = ChunkTable(self.spaced, entries)

    def spaced(self, chunk: str) -> bytes:
        # the library adds one marker itself
        return self.marker if chunk == " " else packed(self.library.encode(chunk[1:], num_threads=1))

    def encode(self, text: str | None) -> np.ndarray:
        """Ids without the end id."""
        if not text:
            return np.zeros(0, np.int32)
        if not self.apart or MARKER in text:
            return np.array(self.library.encode(text, num_threads=1), np.int32)
        if text[0] == " " or text[-1] == " " or "  " in text:
            parts = map(self.marked.__getitem__, MARKED.findall(" " + text))
        else:
            parts = map(self.words.__getitem__, text.split(" "))
        return np.frombuffer(b"".join(parts), np.int32)


    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of ids of each."""
        whole = lambda t: self.encode(t).tobytes()
        return encoded(texts, APART if self.apart else "", self.words.many, whole)


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"{len(ids)}i", *ids)


def codec(path: str) -> PieceCodec:
    tables = process_tables()
    if path not in tables:
        tables[path] = PieceCodec(path)
    return tables[path]


def schema_with(df: DataFrame, name: str, kind: T.DataType, without: str | None = None) -> T.StructType:
    return T.StructType([f for f in df.schema if f.name not in (name, without)]).add(name, kind)


def extended(batch: pa.RecordBatch, name: str, values: pa.Array, without: str | None = None) -> pa.RecordBatch:
    keep = [i for i, n in enumerate(batch.schema.names) if n not in (name, without)]
    return pa.RecordBatch.from_arrays([batch.column(i) for i in keep] + [values], [batch.schema.names[i] for i in keep] + [name])


def encode(docs: DataFrame, model: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the column ``text`` replaced by ``ids`` (array<int>) with the end id; a null or empty text has the end id only,
    repeated rows the same ids, an empty table no rows."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for batch in light(rows, text):
            flat, stops = ended(*c.encode_all(batch.column(batch.schema.get_field_index(text))), c.end)
            yield extended(batch, ids, pa.ListArray.from_arrays(pa.array(stops.astype(np.int32)), pa.array(flat.view(np.int32))), text)

    return docs.mapInArrow(run, schema_with(docs, ids, T.ArrayType(T.IntegerType()), text))


def decode(rows: DataFrame, model: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``rows`` with the library's decoding of ``ids`` (null: empty) in ``text``."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for batch in filled(rows):
            column = batch.column(batch.schema.get_field_index(ids))
            # one row's ids at a time: as Python numbers they are large
            each = [c.library.decode(x.as_py() or []) for x in column]
            yield extended(batch, text, pa.array(each, pa.string()))

    return rows.mapInArrow(run, schema_with(rows, text, T.StringType()))


def digests(rows: DataFrame, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``ids`` as their decimal numbers' sha256, ``text`` as its own."""
    return rows.select("doc_id", F.size(ids).cast("long").alias("n_tokens"), F.sha2(F.concat_ws(" ", F.col(ids).cast("array<string>")), 256).alias("ids_sha256"),
                       F.sha2(text, 256).alias("decoded_sha256"))


def op9_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path(MODEL)
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return digests(decode(encode(docs, model), model))
