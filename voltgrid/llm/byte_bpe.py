"""Byte-level BPE: each distinct word of the collection is encoded once.

Texts are cut into pre-tokens block by block.  A block (some MB of texts) holds its
distinct words once and, per text, the word number at each position.  Blocks are stored
as a table bucketed by block.  Only their distinct words are shuffled, by word, so that
each word of the whole collection is encoded once; the ids go back to the word's blocks
and are put at the positions of the texts, which stay where they are stored.  Decoding
looks each id up in the token-byte table.

A word that occurs in every block has as many rows as there are blocks, not as it
occurs; a block's rows are bounded by its size, so no task holds more than a block.

Defined cases: a null or empty text has no ids; rows, ids of rows and texts may repeat
or be null, each row is encoded on its own; a text larger than a block is a block;
bytes that are no character count as a mark and are kept, so decoding always gives the
bytes back; a list with an id outside the table decodes to null; an empty table gives an
empty result; only the columns named are kept, and none can clash.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from .common import shared_path, ship

#: bytes of text in a block, and of those cut (characters) or put together (positions) at once
BLOCK_BYTES = 32 << 20
AT_ONCE = 1 << 19

MARK, LETTER, NUMBER, SPACE = range(4)


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> id, from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def character_kinds() -> np.ndarray:
    """Letter, number, white space or mark, per code point, as the library's own patterns see them.

    A vocabulary of single bytes gives back the characters that a pattern matches and
    leaves out all others.
    """
    import tiktoken

    kinds = np.full(0x110000, MARK, np.uint8)
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    single = {bytes([b]): b for b in range(256)}
    for kind, name in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        found = tiktoken.Encoding(name, pat_str=name, mergeable_ranks=single, special_tokens={}).encode_ordinary(every)
        kinds[np.frombuffer(bytes(found).decode().encode("utf-32-le"), "<u4")] = kind
    return kinds


_kinds: list[np.ndarray] = []


def _code_points(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code points of the characters that begin at ``at``; U+FFFD for bytes that are none."""
    out = data[at].astype(np.int64)
    lead = np.flatnonzero(out >= 0x80)
    if not len(lead):
        return out
    place, first = at[lead], out[lead]
    more = [data[np.minimum(place + k, len(data) - 1)].astype(np.int64) & 0x3F for k in (1, 2, 3)]
    two = (first & 0x1F) << 6 | more[0]
    three = (first & 0x0F) << 12 | more[0] << 6 | more[1]
    four = (first & 0x07) << 18 | more[0] << 12 | more[1] << 6 | more[2]
    found = np.select([first < 0xC0, first < 0xE0, first < 0xF0], [0xFFFD, two, three], four)
    out[lead] = np.where(found > 0x10FFFF, 0xFFFD, found)
    return out


def word_starts(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Bytes at which the pre-tokens of texts begin; they tile the texts.

    ``data`` are the UTF-8 bytes of all texts, ``begins`` the first byte of each that is
    not empty.  Words are runs of letters, of numbers and of marks, each with one space
    before it; white space keeps its last character apart where a word follows; an
    apostrophe without space before it takes s, t, m, d, re, ve or ll along.  So the
    runs of equal kinds decide everything, for all characters at once.
    """
    if not _kinds:
        _kinds.append(character_kinds())
    first = (data & 0xC0) != 0x80
    first[begins] = True
    at = np.flatnonzero(first)
    n = len(at)
    kind = _kinds[0][_code_points(data, at)]
    begin = np.zeros(n + 1, bool)
    begin[np.searchsorted(at, begins)] = True
    begin[n] = True
    space = kind == SPACE
    run = np.r_[True, kind[1:] != kind[:-1]] | begin[:n]
    taken = np.r_[False, data[at[:-1]] == 0x20] & ~begin[:n]  # a space stands before
    start = run & (space | ~taken)
    start[:-1] |= space[:-1] & ~space[1:] & ~begin[1:n]

    mark = np.flatnonzero(start & (data[at] == 0x27))
    mark = mark[mark + 1 < n]
    mark = mark[(kind[mark + 1] == LETTER) & ~begin[mark + 1]]
    if len(mark):
        one = data[at[mark + 1]]
        after = np.minimum(mark + 2, n - 1)
        two = np.where((mark + 2 < n) & ~begin[np.minimum(mark + 2, n)], data[at[after]], 0)
        single = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        for which, letters in ((single, 1), (pair, 2)):
            own = mark[which]
            start[own + 1] = False
            behind = own + 1 + letters
            behind = behind[behind < n]
            start[behind[(kind[behind] == LETTER) & ~begin[behind]]] = True
    return at[start]


def _binary(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a column of texts (null: empty)."""
    values = values.cast(pa.large_binary()).fill_null(b"") if values.null_count else values.cast(pa.large_binary())
    at = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    return at - at[0], np.frombuffer(values.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]


def number_words(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Distinct words of some texts, and per text the word numbers at its positions."""
    at, data = _binary(texts)
    if not len(data):
        return pa.array([], pa.large_binary()), pa.array([[]] * len(texts), pa.list_(pa.int32()))
    wide, kind = (np.int64, pa.LargeBinaryArray) if len(data) >= 2**31 else (np.int32, pa.BinaryArray)
    starts, first = [], 0
    while first < len(texts):
        end = max(first + 1, int(np.searchsorted(at, at[first] + AT_ONCE, "right")) - 1)
        own = at[first : end + 1] - at[first]
        if own[-1]:
            starts.append((at[first] + word_starts(data[at[first] : at[end]], own[:-1][np.diff(own) > 0])).astype(wide))
        first = end
    starts = np.concatenate([*starts, np.array([len(data)], wide)])
    ends = np.searchsorted(starts, at).astype(np.int32)
    buffers = [None, pa.py_buffer(starts), pa.py_buffer(data)]
    found = kind.from_buffers(pa.large_binary() if wide is np.int64 else pa.binary(), len(starts) - 1, buffers).dictionary_encode()
    # numbered in the order of the words: neighbours begin alike, which compresses well
    order = pc.array_sort_indices(found.dictionary).to_numpy()
    number = np.empty(len(order), np.int32)
    number[order] = np.arange(len(order), dtype=np.int32)
    return found.dictionary.take(pa.array(order)), pa.ListArray.from_arrays(pa.array(ends), pa.array(number[found.indices.to_numpy()]))


def _blocks(parts: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[pa.Table]:
    """Rows in a row whose texts (the last column) have about ``block_bytes``."""
    held, size = [], 0
    for part in parts:
        at, _ = _binary(part.column(part.num_columns - 1))
        first = 0
        while first < part.num_rows:
            end = int(np.searchsorted(at, at[first] + block_bytes - size, "right")) - 1
            end = min(max(end, first + (not held)), part.num_rows)
            if end > first:
                held.append(part.slice(first, end - first))
                size += int(at[end] - at[first])
            if end < part.num_rows:
                yield pa.Table.from_batches(held)
                held, size = [], 0
            first = end
    if held:
        yield pa.Table.from_batches(held)


def encode(
    docs: DataFrame, path: str, keep: Sequence[str] = ("doc_id",), text_col: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The columns ``keep`` and ``ids``, the token ids of each text (never null)."""
    spark = docs.sparkSession
    ship(spark)
    numbered = [StructField(f"c{k}", docs.schema[c].dataType) for k, c in enumerate(keep)]
    block = StructField("block", LongType())
    codes, words = StructField("codes", ArrayType(IntegerType())), StructField("words", ArrayType(BinaryType()))

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = TaskContext.get().partitionId() << 32
        for table in _blocks(parts, block_bytes):
            table = table.combine_chunks()
            rows, own = table.num_rows, table.columns[:-1]
            known, places = number_words(table.column(table.num_columns - 1).combine_chunks())
            names = ["block", *(f.name for f in numbered), "codes", "words"]
            texts = [pa.array([name] * rows, pa.int64()), *(c.combine_chunks() for c in own), places, pa.nulls(rows, pa.list_(pa.binary()))]
            yield from pa.table(texts, names=names).to_batches(max_chunksize=1_000)
            all_words = pa.ListArray.from_arrays(pa.array([0, len(known)], pa.int32()), known.cast(pa.binary()))
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), *(pa.nulls(1, c.type) for c in own), pa.nulls(1, pa.list_(pa.int32())), all_words], names)
            name += 1

    text = F.col(f"`{text_col}`").cast("string").cast("binary")
    source = docs.select(*[F.col(f"`{c}`").alias(f.name) for c, f in zip(keep, numbered, strict=True)], text)
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = max(spark.sparkContext.defaultParallelism, -(-2 * size // block_bytes) if block_bytes >= AT_ONCE else 1)
    name = f"word_blocks_{uuid.uuid4().hex}"
    cut_texts = source.mapInArrow(cut, StructType([block, *numbered, codes, words]))
    # numbers of words are spread too widely for a dictionary page to help
    plain = {"compression": "zstd", "parquet.compression.codec.zstd.level": "9", "parquet.enable.dictionary": "false", "path": shared_path(spark, "blocks")}
    cut_texts.write.bucketBy(buckets, "block").options(**plain).saveAsTable(name)
    staged = spark.table(name)

    def encode_words(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, last, ids = _encoder(path), None, []
        for part in parts:
            order = np.argsort(part.column(0).to_numpy(), kind="stable")
            found = []
            for word in part.column(2).to_pylist():  # sorted: equal words follow each other
                if word != last:
                    last, ids = word, piece(word)
                found.append(ids)
            own = pa.array(found, pa.list_(pa.int32())).take(pa.array(order))
            blocks, codes = part.column(0).to_numpy()[order], part.column(1).to_numpy()[order]
            after = np.cumsum(pc.list_value_length(own).to_numpy())
            tokens = own.flatten().to_numpy().copy()
            tokens[after - 1] = ~tokens[after - 1]  # marks the last id of a word
            first = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]]) if len(blocks) else np.zeros(0, np.int64)
            ends = np.append(first, len(blocks)).astype(np.int32)
            numbers = pa.ListArray.from_arrays(pa.array(ends), pa.array(codes, pa.int32()))
            ids_of = pa.ListArray.from_arrays(pa.array(np.r_[0, after][ends].astype(np.int32)), pa.array(tokens, pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(blocks[first], pa.int64()), numbers, ids_of], ["block", "codes", "ids"])

    here = staged.where("words IS NOT NULL").select("block", F.posexplode("words").alias("code", "word"))
    sorted_words = here.repartition("word").sortWithinPartitions("word")
    found = sorted_words.mapInArrow(encode_words, "block long, codes array<int>, ids array<int>")

    def rebuild(key: tuple, texts: pa.Table, words: pa.Table) -> pa.Table:
        flat = lambda column: column.combine_chunks().flatten().to_numpy()
        code, ids = (flat(words.column(c)) for c in ("codes", "ids"))
        ends = np.flatnonzero(ids < 0) + 1
        counts, ids = np.diff(np.r_[0, ends]), np.where(ids < 0, ~ids, ids)
        many, first = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
        many[code], first[code] = counts, ends - counts
        places = texts.column("codes").combine_chunks()
        at, numbers = places.offsets.to_numpy().astype(np.int64), places.values.to_numpy()
        chunks, a = [], 0
        while a < len(places):
            b = max(a + 1, int(np.searchsorted(at, at[a] + AT_ONCE, "right")) - 1)
            own = numbers[at[a] : at[b]]
            after = np.cumsum(many[own])
            total = int(after[-1]) if len(after) else 0
            take = np.arange(total) + np.repeat(first[own] - after + many[own], many[own])
            ends = np.r_[0, after][at[a : b + 1] - at[a]]
            chunks.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids[take], pa.int32())))
            a = b
        result = pa.chunked_array(chunks, pa.list_(pa.int32()))
        return pa.Table.from_arrays([*(texts.column(f.name) for f in numbered), result], [*(f.name for f in numbered), "ids"])

    texts = staged.where("words IS NULL").drop("words")
    texts, found = (df.toDF(*df.columns) for df in (texts, found))  # columns of their own: both come from one table
    both = texts.groupBy("block").cogroup(found.groupBy("block"))
    result = both.applyInArrow(rebuild, StructType([*numbered, StructField("ids", ArrayType(IntegerType()))]))
    return result.select(*[F.col(f.name).alias(c) for c, f in zip(keep, numbered, strict=True)], "ids")


_encoders: dict = {}


def _encoder(path: str):
    """The function of this process from a word's bytes to its ids, as the tiktoken library encodes one pre-token."""
    if path not in _encoders:
        import public_tokenizers
        import tiktoken

        made = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(path), special_tokens={})
        _encoders[path] = made._core_bpe.encode_single_piece
    return _encoders[path]


_tables: dict[str, pa.Array] = {}


def token_bytes(path: str) -> pa.Array:
    """The token-byte table: place i holds the bytes of id i (null where there is no such id)."""
    if path not in _tables:
        own = {rank: token for token, rank in read_ranks(path).items()}
        _tables[path] = pa.array([own.get(k) for k in range(max(own, default=-1) + 1)], pa.large_binary())
    return _tables[path]


def decode(ids: Column, path: str) -> Column:
    """The bytes of a list of ids: each id is joined with the token-byte table, whose size the vocabulary bounds."""

    def some(lists: pa.Array) -> pa.Array:
        table = token_bytes(path)
        flat = lists.flatten()
        bad = pc.or_(pc.less(flat, 0), pc.greater_equal(flat, len(table))).fill_null(True)
        pieces = table.take(pc.if_else(bad, pa.scalar(None, flat.type), flat))
        ends = np.r_[0, np.cumsum(pc.list_value_length(lists).fill_null(0).to_numpy())]
        at = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset : pieces.offset + len(pieces) + 1] if len(pieces) else np.zeros(1, np.int64)
        valid = lists.is_valid().to_numpy(zero_copy_only=False)
        if pieces.null_count:
            valid &= np.diff(np.r_[0, np.cumsum(pieces.is_null().to_numpy(zero_copy_only=False))][ends]) == 0
        bounds = pa.py_buffer(np.ascontiguousarray(at[ends]))
        whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lists), [None, bounds, pieces.buffers()[2] or pa.py_buffer(b"")])
        return pc.if_else(pa.array(valid), whole, pa.scalar(None, pa.large_binary())).cast(pa.binary())

    @F.arrow_udf("binary")
    def of(lists: pa.Array) -> pa.Array:
        ends, a, out = lists.offsets.to_numpy(), 0, []
        while a < len(lists):
            b = max(a + 1, int(np.searchsorted(ends, ends[a] + AT_ONCE, "right")) - 1)
            out.append(some(lists.slice(a, b - a)))
            a = b
        return pa.concat_arrays(out) if out else pa.array([], pa.binary())

    return of(ids)
