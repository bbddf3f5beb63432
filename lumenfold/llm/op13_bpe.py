"""Byte-level BPE encoding and decoding with forced boundaries.

A merge only ever makes a token of the vocabulary, so two neighbouring bytes that stand side by side in no token are never
merged across: such a pair marks a certain cut. The pairs of all tokens give a table of 65,536 flags; a text's cuts are one
look-up of its byte pairs in it. The fragments between the cuts are encoded independently, each distinct one once per task,
and their ids are put together again. A run of a million letters is thus as cheap as a million letters of prose.

A cut must also leave the splitting pattern's matches alone. The pattern `'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+|
?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+` looks ahead only behind white space and starts anew only at an apostrophe, so a pair
counts as a cut unless its first byte may end a white-space character, or its second one is an apostrophe or lies within a
character. Strings of added tokens are found first, and what stands between them is encoded by itself.

Cases: null and empty texts have no ids; ids that the vocabulary lacks decode to nothing, and bytes that are no UTF-8 to
U+FFFD, as the tokenizers library does. Rows are independent: repeated rows, null ids and extra columns stay as they are (the
new columns take the given names, which must be free); an empty table gives no rows. The tokenizer's file is read on the
driver and broadcast (a vocabulary of fixed size). Memory: one Arrow batch, and at most CACHE short fragments a task.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from lumenfold.llm.common import table

CACHE, SHORT = 400_000, 64
#: Last bytes of white-space characters in UTF-8, and the control characters that some engines count as such (fixed values).
BLANK_ENDS = [*range(0x09, 0x0E), *range(0x1C, 0x21), *range(0x80, 0x8B), 0x9A, 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable Latin-1 letters stand for themselves, the
    other bytes, in ascending order, for the letters from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {**{chr(b): b for b in own}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class Fragments(dict):
    """Ids of fragments as packed int32: short ones are encoded when first asked for and kept, longer ones are encoded each time."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer = tokenizer

    def __missing__(self, piece: bytes) -> bytes:
        ids = np.array(self.tokenizer.encode(piece.decode(), add_special_tokens=False).ids, np.int32).tobytes()
        if len(piece) <= SHORT:
            if len(self) >= CACHE:
                self.clear()
            self[piece] = ids
        return ids


class Codec:
    """A byte-level BPE tokenizer from its JSON text: certain cuts, ids of fragments, bytes of ids."""

    def __init__(self, source: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(source)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        config = json.loads(source)
        before, added = config["pre_tokenizer"], config["added_tokens"]
        if (config["model"]["type"] != "BPE" or config["normalizer"] or not before or before["type"] != "ByteLevel"
                or before["add_prefix_space"] or not before.get("use_regex", True)):
            raise ValueError("forced boundaries need a byte-level BPE tokenizer without normalizer and prefix space")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("added tokens that reach into their neighbourhood are not supported")
        letters = byte_letters()
        self.bytes = {}
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        joined = np.zeros(65536, bool)
        for token in self.bytes.values():
            b = np.frombuffer(token, np.uint8).astype(np.int64)
            joined[(b[:-1] << 8) + b[1:]] = True
        self.cut = ~joined.reshape(256, 256)
        self.cut[BLANK_ENDS] = False
        self.cut[:, 0x27] = False
        self.cut[:, 0x80:0xC0] = False
        self.cut = self.cut.ravel()
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self.added = re.compile(b"|".join(re.escape(x.encode()) for x in names)) if names else None
        self.fragments = Fragments(self.tokenizer)

    def cuts(self, data: np.ndarray) -> np.ndarray:
        """Positions i between bytes i - 1 and i of data that no token spans."""
        pair = data[:-1].astype(np.uint16) << np.uint16(8) | data[1:]
        return np.flatnonzero(self.cut[pair]) + 1

    def bounds(self, text: bytes, data: np.ndarray) -> np.ndarray:
        """Bounds of the fragments of a whole text."""
        inner = self.cuts(data)
        if self.added and (found := [m.span() for m in self.added.finditer(text)]):
            first, last = (np.array(x) for x in zip(*found))
            i = np.searchsorted(first, inner, "left") - 1
            inner = np.union1d(inner[(i < 0) | (inner >= last[i])], np.concatenate([first, last]))
        return np.unique(np.concatenate([[0], inner, [len(text)]]))

    def encode(self, text: bytes) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        at = self.bounds(text, np.frombuffer(text, np.uint8)).tolist()
        pieces = [text[a:b] for a, b in zip(at, at[1:])]
        return np.frombuffer(b"".join(map(self.fragments.__getitem__, pieces)), np.int32)

    def decode(self, ids: list[int]) -> str:
        return b"".join([self.bytes.get(i, b"") for i in ids]).decode("utf-8", "replace")


@lru_cache(2)
def codec(source: str) -> Codec:
    return Codec(source)


def _shared(df: DataFrame, path: str | None):
    with open(path or default_path(), encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def _free(df: DataFrame, name: str) -> None:
    if name.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"the table has a column {name} already")


def _large(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, values], [*batch.schema.names, name])


def encode(docs: DataFrame, text_col: str = "text", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """docs with the ids of each whole text as array<int>."""
    _free(docs, ids_col)
    source, place = _shared(docs, path), docs.columns.index(text_col)

    def run(batches):
        own = codec(source.value)
        for batch in batches:
            ids = [own.encode((t.as_py() or "").encode()) for t in batch.column(place)]
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
            yield _large(batch, ids_col, pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat)))

    return docs.mapInArrow(run, StructType([*docs.schema.fields]).add(ids_col, ArrayType(IntegerType())))


def decode(rows: DataFrame, ids_col: str = "ids", text_col: str = "decoded", path: str | None = None) -> DataFrame:
    """rows with the text that each array of ids stands for; null and empty arrays give an empty text."""
    _free(rows, text_col)
    source, place = _shared(rows, path), rows.columns.index(ids_col)

    def run(batches):
        own = codec(source.value)
        for batch in batches:
            texts = [own.decode(ids.values.to_numpy(zero_copy_only=False).tolist() if ids.is_valid else []) for ids in batch.column(place)]
            yield _large(batch, text_col, pa.array(texts, pa.string()))

    return rows.mapInArrow(run, StructType([*rows.schema.fields]).add(text_col, StringType()))


def op13(spark, sf_dir) -> DataFrame:
    coded = decode(encode(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


QUERIES = {"op13_byte_pairs": op13}
