"""BPE encoding and decoding through a distinct-word table.

Encoding, in three steps that Spark partitions:

1. Split. A task splits its texts into the tokenizer's words, chunk by chunk
   (``CHUNK_CHARS`` of text), and numbers the distinct words of the chunk. A
   chunk gives one row with its texts as sequences of word numbers, and its
   distinct words packed into one row per word bucket (a hash of the word).
2. Encode. Grouped by bucket, every distinct word of the corpus is encoded
   once; each chunk gets the ids of its words back. The number of buckets
   grows with the rows and with the bytes of text, so a group stays small
   whether the texts are many or long; a word is in a group at most once per
   chunk, so frequent words make no hot group.
3. Join by position. Grouped by chunk, the number at each position is replaced
   by its word's ids.

Words and numbers travel packed and compressed, since the corpus as one row
per word position would be many times the size of the texts.

Decoding joins ids to pieces on the map side: the vocabulary is a table of
fixed size (its file's), so every task holds it; ids are never shuffled.

Words are split as by the byte-level pre-tokenizer of the tokenizer file, and
its added tokens are cut out first, as the tokenizers library does. Each word
is encoded by that library's model.

Cases: a null text counts as empty and gets no ids. Repeated rows and ids are
rows of their own. Other columns are ignored. A text is never cut: a very long
one is a chunk of its own. An empty table gives no rows.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import new_path, ship

# The byte-level pre-tokenizer's fixed pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Where the pattern's engine and the library's agree on every character's class
# (a test compares them all). Texts with other characters, which newer Unicode
# versions may have classed anew, are split by the library itself.
AGREED = "\u0000-\u0557\u2000-\u206f\u20a0-\u20bf\u2100-\u214f\u2190-\u23ff\u4e00-\u9fa5\uac00-\ud7a3"
CHUNK_CHARS = 12_000_000
ROWS_PER_BUCKET = 4096
BYTES_PER_BUCKET = 16 << 20
_ENCODE_BATCH = 8192
_DECODE_ROWS = 512


# -- packing ----------------------------------------------------------------

def _pack(*parts: bytes, level: int = 3) -> bytes:
    import zstandard
    return zstandard.ZstdCompressor(level).compress(
        struct.pack(f"<{len(parts) + 1}Q", len(parts), *map(len, parts)) + b"".join(parts))


def _unpack(blob: bytes) -> list[bytes]:
    import zstandard
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, = struct.unpack_from("<Q", raw)
    sizes = struct.unpack_from(f"<{n}Q", raw, 8)
    out, at = [], 8 + 8 * n
    for size in sizes:
        out.append(raw[at:at + size])
        at += size
    return out


def _planes(values: np.ndarray) -> bytes:
    """uint32 values as four byte planes, which compress far better."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _pack_sequence(values: np.ndarray) -> list[bytes]:
    """Numbers that are smaller the more frequent: one byte each, with 255 for
    those that follow in two bytes, and 65535 there for those in four."""
    second = values[values >= 255]
    third = second[second >= 65535]
    return [np.minimum(values, 255).astype(np.uint8).tobytes(),
            np.ascontiguousarray(np.minimum(second, 65535).astype("<u2").view(np.uint8).reshape(-1, 2).T).tobytes(),
            _planes(third)]


def _unpack_sequence(first: bytes, second: bytes, third: bytes) -> np.ndarray:
    out = np.frombuffer(first, np.uint8).astype(np.uint32)
    two = np.ascontiguousarray(np.frombuffer(second, np.uint8).reshape(2, -1).T).view("<u2").ravel().astype(np.uint32)
    two[two == 65535] = _from_planes(third)
    out[out == 255] = two
    return out


def _ragged_take(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, pick: np.ndarray) -> np.ndarray:
    """The slices ``pick`` of a ragged array, one after the other."""
    n = sizes[pick]
    ends = np.cumsum(n)
    if not len(ends) or not ends[-1]:
        return flat[:0]
    at = np.arange(ends[-1]) + np.repeat(starts[pick] - (ends - n), n)
    return flat[at]


# -- tokenizer --------------------------------------------------------------

@lru_cache(maxsize=4)
def _tokenizer(path: str):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@lru_cache(maxsize=4)
def _splitter(path: str):
    """Function from a text to its words; an added token is a word of its own."""
    import regex
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    agreed_words = regex.compile(PATTERN).findall
    other = regex.compile(f"[^{AGREED}]").search
    pre = _tokenizer(path).pre_tokenizer.pre_tokenize_str

    def words(text: str) -> list[str]:
        if other(text) is None:
            return agreed_words(text)
        return [text[a:b] for _, (a, b) in pre(text)]

    added = [t["content"] for t in spec.get("added_tokens", [])]
    if not added:
        return words
    cut = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")")

    def split(text: str) -> list[str]:
        if cut.search(text) is None:
            return words(text)
        out = []
        for i, part in enumerate(cut.split(text)):
            if i % 2:
                out.append(part)
            else:
                out += words(part)
        return out

    return split


@lru_cache(maxsize=4)
def _pieces(path: str) -> list[bytes]:
    """The id-to-piece table: each id's bytes."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in printable}
    byte_of |= {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(printable)))}
    vocab = spec["model"]["vocab"]
    table = [b""] * (1 + max([*vocab.values(), *(t["id"] for t in spec.get("added_tokens", []))]))
    for piece, i in vocab.items():
        table[i] = bytes(byte_of[c] for c in piece)
    for t in spec.get("added_tokens", []):
        table[t["id"]] = t["content"].encode()
    return table


# -- encode -----------------------------------------------------------------

def _chunks(path: str, buckets: int, id_type: pa.DataType, chunk_chars: int):
    names = ["chunk", "bucket", "doc_ids", "blob"]

    def rows(ids: list, sequences: list[np.ndarray], numbers: dict[str, int]) -> pa.RecordBatch:
        chunk = uuid.uuid4().hex
        sizes = np.array([len(s) for s in sequences], "<u4")
        flat = np.concatenate(sequences) if sequences else np.zeros(0, np.uint32)
        # From here on the numbers are ranks by frequency, which pack well.
        rank = np.empty(len(numbers), np.uint32)
        rank[np.argsort(-np.bincount(flat, minlength=len(numbers)), kind="stable")] = np.arange(len(numbers))
        flat = rank[flat]
        by_bucket: dict[int, list[str]] = defaultdict(list)
        for word in numbers:
            by_bucket[zlib.crc32(word.encode()) % buckets].append(word)
        blobs, keys = [_pack(_planes(sizes), *_pack_sequence(flat))], [-1]
        for bucket, words in by_bucket.items():
            words.sort()
            encoded = [w.encode() for w in words]
            blobs.append(_pack(_planes(rank[[numbers[w] for w in words]]),
                               _planes(np.array([len(w) for w in encoded], "<u4")), b"".join(encoded), level=9))
            keys.append(bucket)
        return pa.RecordBatch.from_arrays(
            [pa.array([chunk] * len(keys)), pa.array(keys, pa.int32()),
             pa.array([ids] + [None] * (len(keys) - 1), pa.list_(id_type)), pa.array(blobs, pa.binary())],
            names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = _splitter(path)
        ids, sequences, chars = [], [], 0
        numbers: dict[str, int] = defaultdict(count().__next__)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                text = text.as_py() or ""
                words = split(text)
                sequences.append(np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words)))
                ids.append(doc_id.as_py())
                chars += len(text)
                if chars >= chunk_chars:
                    yield rows(ids, sequences, numbers)
                    ids, sequences, chars = [], [], 0
                    numbers = defaultdict(count().__next__)
        if ids:
            yield rows(ids, sequences, numbers)

    return run


def _encode_bucket(path: str):
    def run(pdf):
        import os
        import pandas as pd
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        parts = []
        place: dict[bytes, int] = {}
        for blob in pdf["blob"]:
            numbers, sizes, raw = _unpack(blob)
            ends = np.cumsum(_from_planes(sizes)).tolist()
            words = [raw[a:b] for a, b in zip([0, *ends], ends)]
            parts.append((numbers, np.array([place.setdefault(w, len(place)) for w in words], np.int64)))
        # The distinct words of this bucket, each encoded once.
        distinct, sizes, flat = list(place), [], []
        for at in range(0, len(distinct), _ENCODE_BATCH):
            batch = [w.decode() for w in distinct[at:at + _ENCODE_BATCH]]
            ids = [e.ids for e in _tokenizer(path).encode_batch(batch, add_special_tokens=False)]
            sizes.append(np.array([len(i) for i in ids], np.int64))
            flat.append(np.array([x for i in ids for x in i], np.uint32))
        sizes, flat = np.concatenate(sizes), np.concatenate(flat)
        starts = np.cumsum(sizes) - sizes
        return pd.DataFrame({"chunk": pdf["chunk"], "blob": [
            _pack(numbers, _planes(sizes[pick]), _planes(_ragged_take(flat, starts, sizes, pick)))
            for numbers, pick in parts]})

    return run


def _joiner(path: str | None):
    """Cogroup function of a chunk's sequences with its words' ids; with a
    tokenizer path it decodes what it has joined in the same pass."""
    def run(sequences, words):
        out = _join_ids(sequences, words)
        if path is not None:
            out["text"] = _decode_all(out["ids"], path)
        return out
    return run


def _join_ids(sequences, words):
    import pandas as pd
    numbers, sizes, flat = [], [], []
    for blob in words["blob"]:
        a, b, c = _unpack(blob)
        numbers.append(_from_planes(a))
        sizes.append(_from_planes(b))
        flat.append(_from_planes(c))
    none = [np.zeros(0, np.uint32)]
    number = np.concatenate(numbers or none).astype(np.int64)
    size = np.concatenate(sizes or none).astype(np.int64)
    flat = np.concatenate(flat or none)
    start = np.cumsum(size) - size
    by_number = np.empty(len(number), np.int64)
    by_number[number] = np.arange(len(number))
    start, size = start[by_number], size[by_number]
    ids, out = [], []
    for doc_ids, blob in zip(sequences["doc_ids"], sequences["blob"]):
        lengths, *sequence = _unpack(blob)
        lengths, sequence = _from_planes(lengths), _unpack_sequence(*sequence)
        ends = np.cumsum(lengths, dtype=np.int64)
        for doc_id, a, b in zip(doc_ids, ends - lengths, ends):
            ids.append(doc_id)
            out.append(_ragged_take(flat, start, size, sequence[a:b].astype(np.int64)).astype("<u4").tobytes())
    return pd.DataFrame({"doc_id": pd.Series(ids, dtype=object), "ids": pd.Series(out, dtype=object)})


def _bucket_count(source: DataFrame) -> int:
    """Word buckets: one per ``ROWS_PER_BUCKET`` rows or ``BYTES_PER_BUCKET`` of text, whichever are more."""
    rows, size = source.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    return max(1, -(-rows // ROWS_PER_BUCKET), -(-(size or 0) // BYTES_PER_BUCKET))


def encode(docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text",
           chunk_chars: int = CHUNK_CHARS, decoded: bool = False) -> DataFrame:
    """(doc_id, ids) of every row; ids are little-endian unsigned 32-bit integers.

    With ``decoded`` also ``text``, decoded from the ids as by ``decode`` but
    without handing them to another Python worker.
    """
    ship(docs.sparkSession)
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    buckets = _bucket_count(source)
    from pyspark.sql.pandas.types import to_arrow_type
    rows = _staged_by_chunk(source.mapInArrow(
        _chunks(tokenizer_path, buckets, to_arrow_type(source.schema["doc_id"].dataType), chunk_chars),
        f"chunk string, bucket int, doc_ids array<{kind}>, blob binary"))
    words = rows.where("bucket >= 0").select("chunk", "bucket", "blob") \
        .groupBy("bucket").applyInPandas(_encode_bucket(tokenizer_path), "chunk string, blob binary")
    sequences = rows.where("bucket < 0").select("chunk", "doc_ids", "blob")
    return sequences.groupBy("chunk").cogroup(words.groupBy("chunk")) \
        .applyInPandas(_joiner(tokenizer_path if decoded else None),
                       f"doc_id {kind}, ids binary{', text string' if decoded else ''}")


def _staged_by_chunk(rows: DataFrame) -> DataFrame:
    """Stage as a table bucketed by chunk, so that the sequences, which are
    most of it, join their words' ids without another shuffle. A task writes
    the few chunks it has made, so this makes few files."""
    spark = rows.sparkSession
    name = f"bpe_chunks_{uuid.uuid4().hex}"
    rows.write.option("path", new_path(spark, "words")).option("compression", "none") \
        .bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "chunk").saveAsTable(name)
    return spark.table(name)


def _decode_all(ids, path: str) -> list[str]:
    piece = _pieces(path).__getitem__
    return [b"".join(map(piece, np.frombuffer(x or b"", "<u4").tolist())).decode("utf-8", "replace") for x in ids]


def decode(encoded: DataFrame, tokenizer_path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``encoded`` plus the text of each row's ids, special tokens included."""
    ship(encoded.sparkSession)
    rest = [c for c in encoded.columns if c != text]
    source = encoded.select(*rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, _DECODE_ROWS) for b in batches for at in range(0, max(1, b.num_rows), _DECODE_ROWS)):
            texts = _decode_all((x.as_py() for x in batch.column(ids)), tokenizer_path)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in rest] + [pa.array(texts, pa.string())],
                                             names=[*rest, text])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema)
    return source.mapInArrow(run, f"{schema}, `{text}` string")
