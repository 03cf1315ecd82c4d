"""Encoding with a public byte-level tokenizer, and back.

Texts are encoded in Arrow batches inside the Python workers, one tokenizer a worker, in sub-batches
of bounded size so that very long texts don't pile up. Null and empty texts have the empty list of
ids. Strings that look like special tokens are ordinary text. Repeated rows are encoded each.

Offsets are given in characters of the text: byte-level tokens may split a character, and then each
of its tokens has the offsets of the whole character. Decoding reverses the byte table and joins
bytes before it reads UTF-8, so split characters come back whole; bytes that are no UTF-8 (a list of
ids cut inside a character) become the replacement character.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wattlake.session import spread

#: Characters given to the library at once.
SUB_BATCH_CHARS = 1_000_000


def tokenizer_file(name: str = "byte_bpe_50k.json", folder: str | None = None) -> str:
    """Where a public tokenizer lies: ``folder``, else the variable WATTLAKE_TOKENIZERS, else /opt/tokenizers, else the installed package."""
    for d in (folder, os.environ.get("WATTLAKE_TOKENIZERS"), "/opt/tokenizers"):
        if d and os.path.exists(os.path.join(d, name)):
            return os.path.join(d, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))


@cache
def _load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


def encode_texts(texts: list[str | None], path: str, offsets: bool = False) -> Iterator:
    """The library's encoding of each text; None for null and empty ones."""
    t = _load(path)
    run = t.encode_batch if offsets or not hasattr(t, "encode_batch_fast") else t.encode_batch_fast
    part: list[str] = []
    slots: list[bool] = []
    size = 0

    def flush() -> Iterator:
        done = iter(run(part, add_special_tokens=False))
        for filled in slots:
            yield next(done) if filled else None

    for x in texts:
        slots.append(bool(x))
        if x:
            part.append(x)
            size += len(x)
        if size >= SUB_BATCH_CHARS or len(slots) >= 10_000:
            yield from flush()
            part, slots, size = [], [], 0
    yield from flush()


def encode(df: DataFrame, id_: str, text: str, name: str = "byte_bpe_50k.json", folder: str | None = None) -> DataFrame:
    """(id, ids array<int>) for each row."""
    d = spread(df.select(F.col(id_), F.col(text).cast("string").alias("__text")))
    kind = d.schema[id_].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer_file(name, folder)
        for b in batches:
            for lo in range(0, b.num_rows, 2_000):
                s = b.slice(lo, 2_000)
                ids = [e.ids if e else [] for e in encode_texts(s.column(1).to_pylist(), path)]
                yield pa.RecordBatch.from_arrays([s.column(0), pa.array(ids, pa.list_(pa.int32()))], [id_, "ids"])

    return d.mapInArrow(run, f"`{id_}` {kind}, ids array<int>")


def count_tokens(df: DataFrame, id_: str, text: str, name: str = "byte_bpe_50k.json", folder: str | None = None) -> DataFrame:
    """(id, tokens bigint) for each row."""
    d = spread(df.select(F.col(id_), F.col(text).cast("string").alias("__text")))
    kind = d.schema[id_].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer_file(name, folder)
        for b in batches:
            n = [len(e.ids) if e else 0 for e in encode_texts(b.column(1).to_pylist(), path)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], [id_, "tokens"])

    return d.mapInArrow(run, f"`{id_}` {kind}, tokens bigint")


def encode_with_offsets(df: DataFrame, id_: str, text: str, name: str = "byte_bpe_50k.json", folder: str | None = None) -> DataFrame:
    """(id, ids, starts, ends): tokens with the character range each of them touches."""
    d = spread(df.select(F.col(id_), F.col(text).cast("string").alias("__text")))
    kind = d.schema[id_].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer_file(name, folder)
        ints = pa.list_(pa.int32())
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                s = b.slice(lo, 500)
                ids, starts, ends = [], [], []
                for e in encode_texts(s.column(1).to_pylist(), path, offsets=True):
                    ids.append(e.ids if e else [])
                    starts.append([a for a, _ in e.offsets] if e else [])
                    ends.append([z for _, z in e.offsets] if e else [])
                yield pa.RecordBatch.from_arrays([s.column(0), pa.array(ids, ints), pa.array(starts, ints), pa.array(ends, ints)], [id_, "ids", "starts", "ends"])

    return d.mapInArrow(run, f"`{id_}` {kind}, ids array<int>, starts array<int>, ends array<int>")


def byte_table() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies, reversed: printable bytes stand for themselves, the others for characters from 256 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


@cache
def _pieces(path: str) -> list[bytes]:
    t = _load(path)
    table = byte_table()
    out = [b""] * t.get_vocab_size()
    for piece, i in t.get_vocab().items():
        out[i] = bytes(table[c] for c in piece) if all(c in table for c in piece) else piece.encode()
    return out


def decode_ids(ids: list[int], path: str) -> str:
    p = _pieces(path)
    return b"".join(p[i] for i in ids).decode("utf-8", errors="replace")


def decode(df: DataFrame, id_: str, ids: str = "ids", name: str = "byte_bpe_50k.json", folder: str | None = None) -> DataFrame:
    """(id, text) for each row of ids; null ids give a null text."""
    d = df.select(F.col(id_), F.col(ids).alias("__ids"))
    kind = d.schema[id_].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer_file(name, folder)
        for b in batches:
            texts = [None if x is None else decode_ids(x, path) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], [id_, "text"])

    return d.mapInArrow(run, f"`{id_}` {kind}, text string")
