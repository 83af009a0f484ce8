"""Removal of repeated passages: every byte of a string of ``width`` bytes that also starts in a document with a smaller id.

Order of work, for a collection that no task can hold:

1. Documents are dealt into blocks of a few MB and stored as a bucketed table, which
   later steps read block by block without another shuffle.  Rows equal in id and text
   stand in one block, unless together they outweigh a block: those are spread over all.
2. Every string of ``width`` bytes belongs to its minimiser, the smallest hash among its
   substrings of `ANCHOR` bytes; equal strings have equal minimisers, and neighbours
   mostly share theirs.  Blocks send their distinct minimisers; those of at least two
   documents come back.
3. Only stretches with such a minimiser go on, each distinct one once per block, to the
   part of their minimiser.  A minimiser that very many documents share is split: its
   strings go out one by one, each to the part of its own hash.
4. In a part, the strings are ordered column by column: each round puts one more symbol
   in front of every string's suffix, reads the transform (the symbols ahead of the
   suffixes in suffix order), moves the suffixes by a stable counting sort of it and
   updates which neighbours have their whole prefix in common.  After ``width`` rounds
   equal strings stand together, and the smallest id of each goes back to the blocks.
5. Blocks mark what stands in a smaller document and cut it out.

Every exchange is a few compressed arrays per block and part, so copies and frequent
passages are combined before they are sent and no task sees all rows of a group.

Defined cases: a null text counts as empty; texts shorter than ``width`` stay whole;
rows with equal ids never remove each other's bytes; a null id counts as larger than
all; an empty table gives an empty result; other columns are handed through in a struct,
so their names cannot clash.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from .common import remove_path, shared_path, ship, stored

WIDTH = 50
#: bytes of a minimiser
ANCHOR = 20
#: bytes of text in a block, blocks for each part of the minimisers
BLOCK_BYTES = 4 * 1024 * 1024
BLOCKS_PER_PART = 2
#: what a row counts besides its text when rows equal in id and text are weighed against a block
ROW_BYTES = 64
#: documents that share a minimiser before it is split
CROWD = 4_096
#: bytes that are hashed at once, strings that are ordered at once
SLICE = 1 << 18
PLACE_BITS = 20
ORDERED = 1_000_000

KEY_BITS = 40
LAST = np.iinfo(np.int64).max
MESSAGES = "block int, part int, kind int, payload binary"

_BASE, _MIX = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9
_ALL = (1 << 64) - 1


# ---------------------------------------------------------------- arrays as bytes


def pack_arrays(*arrays: np.ndarray) -> bytes:
    """Arrays in one compressed value; bytes of equal weight stand together, which compresses sorted numbers."""
    sizes, planes = [len(arrays)], []
    for a in arrays:
        a = np.ascontiguousarray(a)
        sizes += [len(a), a.dtype.itemsize, ord(a.dtype.kind)]
        planes.append(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes())
    body = np.array(sizes, np.int64).tobytes() + b"".join(planes)
    return len(body).to_bytes(8, "little") + pa.compress(body, codec="zstd", asbytes=True)


def unpack_arrays(value: bytes) -> list[np.ndarray]:
    body = pa.decompress(value[8:], int.from_bytes(value[:8], "little"), codec="zstd", asbytes=True)
    count = int(np.frombuffer(body, np.int64, 1)[0])
    sizes = np.frombuffer(body, np.int64, 1 + 3 * count)[1:].reshape(count, 3)
    at, out = 8 * (1 + 3 * count), []
    for n, width, kind in sizes.tolist():
        plane = np.frombuffer(body, np.uint8, n * width, at).reshape(width, n)
        out.append(np.ascontiguousarray(plane.T).view(f"{chr(kind)}{width}").reshape(n))
        at += n * width
    return out


def gaps(keys: np.ndarray) -> np.ndarray:
    """Sorted keys as differences, which `pack_arrays` makes small."""
    return np.diff(keys, prepend=np.uint64(0))


# ---------------------------------------------------------------- minimisers


def _hashes(data: np.ndarray) -> np.ndarray:
    """Hash of every substring of `ANCHOR` bytes, from those of half, quarter ... its length."""
    part, size, factor = data.astype(np.uint64), 1, _BASE
    total, done, rest = None, 0, ANCHOR
    while rest:
        if rest & 1:
            if total is None:
                total = part
            else:  # the longer string stands in front
                n = len(data) - (size + done) + 1
                total = part[:n] * np.uint64(front) + total[size : size + n]
            done += size
            front = pow(_BASE, done, 1 << 64)
        rest >>= 1
        if rest:
            part = part[:-size] * np.uint64(factor) + part[size:]
            size, factor = 2 * size, factor * factor & _ALL
    total ^= total >> np.uint64(31)
    total *= np.uint64(_MIX)
    return total ^ (total >> np.uint64(29))


def _stretches(data: np.ndarray, valid: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, number of strings, key) of the runs of neighbouring strings with one minimiser."""
    hashed = _hashes(data)
    place_bits = np.uint64(PLACE_BITS)
    key = ((hashed >> place_bits) << place_bits) | np.arange(len(hashed), dtype=np.uint64)
    reach, step = width - ANCHOR + 1, 1
    while 2 * step <= reach:
        key = np.minimum(key[:-step], key[step:])
        step *= 2
    if step < reach:
        key = np.minimum(key[: len(key) - (reach - step)], key[reach - step :])
    place = (key & ((np.uint64(1) << place_bits) - np.uint64(1))).astype(np.int64)
    new = np.r_[True, (place[1:] != place[:-1]) | (valid[1:] != valid[:-1])]
    starts = np.flatnonzero(new)
    counts = np.diff(np.r_[starts, len(place)])
    keep = valid[starts]
    starts, counts = starts[keep], counts[keep]
    # the smallest of many hashes is small: mixed again, keys fall evenly into the parts
    least = hashed[place[starts]] * np.uint64(_BASE)
    return starts, counts, (least ^ (least >> np.uint64(32))) * np.uint64(_MIX) >> np.uint64(64 - KEY_BITS)


def stretches(data: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`_stretches` of texts that stand in a row in ``data``, the i-th up to ``ends[i]``."""
    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    valid = np.ones(len(data), bool)
    for a, b in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist(), strict=True):
        valid[max(a, b - width + 1) : b] = False
    out = []
    for at in range(0, n, SLICE):
        many = min(SLICE, n - at)
        starts, counts, keys = _stretches(data[at : at + many + width - 1], valid[at : at + many], width)
        out.append((starts + at, counts, keys))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


# ---------------------------------------------------------------- blocks


class Block:
    """The documents of a block, in the order of id and text."""

    def __init__(self, table: pa.Table, width: int):
        texts, ids = table.column("text").to_pylist(), table.column("id").to_pylist()
        ids = [int(LAST) if i is None else i for i in ids]
        self.rows = sorted(range(len(ids)), key=lambda r: (ids[r], texts[r]))
        self.ids = np.array([ids[r] for r in self.rows], np.int64)
        self.texts = [texts[r] for r in self.rows]
        self.ends = np.cumsum([len(t) for t in self.texts]).astype(np.int64)
        self.whole = b"".join(self.texts)
        self.data = np.frombuffer(self.whole, np.uint8)
        self.width = width
        self.starts, self.counts, self.keys = stretches(self.data, self.ends, width)
        self.doc = np.searchsorted(self.ends, self.starts, side="right")

    def minimisers(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys and in how many of the ids each occurs."""
        order = np.lexsort((self.ids[self.doc], self.keys))
        keys, ids = self.keys[order], self.ids[self.doc][order]
        first = np.r_[True, (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])] if len(keys) else np.zeros(0, bool)
        return np.unique(keys[first], return_counts=True)

    def shared(self, common: np.ndarray, crowded: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The stretches whose key is in ``common``, those in ``crowded`` string by string.

        Returns the distinct ones in the order of (key, bytes), their keys, and per
        occurrence its place in that list, its start and its number of strings.
        """
        picked = np.flatnonzero(_among(self.keys, common))
        starts, counts, keys = self.starts[picked], self.counts[picked], self.keys[picked]
        split = _among(keys, crowded)
        many = np.where(split, counts, 1)
        inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        starts, counts, keys = np.repeat(starts, many) + inside, np.repeat(np.where(split, 1, counts), many), np.repeat(keys, many)
        whole, last = self.whole, self.width - 1
        strings = [whole[a : a + c + last] for a, c in zip(starts.tolist(), counts.tolist(), strict=True)]
        own = np.flatnonzero(np.repeat(split, many))
        if len(own):
            from xxhash import xxh64_intdigest

            keys[own] = np.array([xxh64_intdigest(strings[i]) >> (64 - KEY_BITS) for i in own.tolist()], np.uint64)
        places: dict[bytes, int] = {}
        at = np.array([places.setdefault(s, len(places)) for s in strings], np.int64)
        distinct = list(places)
        key_of = np.zeros(len(distinct), np.uint64)
        key_of[at] = keys
        order = sorted(range(len(distinct)), key=lambda i: (int(key_of[i]), distinct[i]))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        return [distinct[i] for i in order], key_of[order], rank[at], starts, counts


def _among(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return known[at] == keys


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """Parts are ranges of keys, so sorted keys fall into slices."""
    return (keys * np.uint64(parts)) >> np.uint64(KEY_BITS)


def _messages(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    """The result of a group; what Arrow has freed goes back to the system before the next one."""
    pa.default_memory_pool().release_unused()
    columns = list(zip(*rows, strict=True)) or [()] * 4
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary())
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["block", "part", "kind", "payload"])


def _slices(keys: np.ndarray, parts: int) -> Iterator[tuple[int, slice]]:
    own = part_of(keys, parts)
    bounds = np.searchsorted(own, np.arange(parts + 1, dtype=np.uint64))
    for part, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        if b > a:
            yield part, slice(a, b)


#: kinds of messages: minimisers of a block, those that come back, stretches, their smallest ids
KEYS, COMMON, STRINGS, FOUND = range(4)


def _send_keys(width: int, parts: int):
    def send(table: pa.Table) -> pa.Table:
        keys, docs = Block(table, width).minimisers()
        block = table.column("block")[0].as_py()
        return _messages([(block, part, KEYS, pack_arrays(gaps(keys[s]), docs[s].astype(np.uint32))) for part, s in _slices(keys, parts)])

    return send


def _return_common(crowd: int):
    def common(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        blocks = table.column("block").to_pylist()
        keys, many, sizes = [], [], []
        for value in table.column("payload"):
            own, docs = unpack_arrays(value.as_py())
            keys.append(np.cumsum(own, dtype=np.uint64))
            many.append(docs)
            sizes.append(len(own))
        joined, docs = np.concatenate(keys), np.concatenate(many)
        del keys, many
        # equal keys stand together; the documents of each are summed and written back to its places
        order = np.argsort(joined, kind="stable")
        ranked = joined[order]
        first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
        total = np.add.reduceat(docs[order].astype(np.int64), first)
        docs = np.empty(len(order), np.int64)
        docs[order] = np.repeat(total, np.diff(np.r_[first, len(order)]))
        del order, ranked, first, total
        rows, a = [], 0
        for block, n in zip(blocks, sizes, strict=True):
            own, met = joined[a : a + n], docs[a : a + n]
            a += n
            both = own[met > 1]
            if len(both):
                rows.append((block, part, COMMON, pack_arrays(gaps(both), gaps(own[met >= crowd]))))
        return _messages(rows)

    return common


def _common_of(messages: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    both = [unpack_arrays(v) for v, k in zip(messages.column("payload").to_pylist(), messages.column("kind").to_pylist(), strict=True) if k == COMMON]
    joined = [np.sort(np.concatenate([np.cumsum(x[i], dtype=np.uint64) for x in both])) if both else np.zeros(0, np.uint64) for i in (0, 1)]
    return joined[0], joined[1]


def _send_strings(width: int, parts: int):
    def send(docs: pa.Table, messages: pa.Table) -> pa.Table:
        if not docs.num_rows or not messages.num_rows:
            return _messages([])
        block = Block(docs, width)
        strings, keys, at, starts, _ = block.shared(*_common_of(messages))
        first = np.full(len(strings), LAST, np.int64)
        np.minimum.at(first, at, block.ids[np.searchsorted(block.ends, starts, side="right")])
        name, rows = docs.column("block")[0].as_py(), []
        for part, s in _slices(keys, parts):
            own = strings[s]
            sizes = np.array([len(x) for x in own], np.uint32)
            rows.append((name, part, STRINGS, pack_arrays(gaps(keys[s]), first[s], sizes, np.frombuffer(b"".join(own), np.uint8))))
        return _messages(rows)

    return send


def column_order(data: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings ``data[s : s + width]`` and the class of each in that order; equal strings share a class.

    Each round inserts one symbol in front of every suffix.  ``ahead`` is the transform
    of the collection at this point: the symbols that precede the suffixes, in the order
    of the suffixes.  Its stable sort gives their new places; neighbours keep their
    prefix in common if they had it in common and got the same symbol.
    """
    order, common = np.arange(len(starts)), np.zeros(len(starts), np.int64)
    for column in range(width - 1, -1, -1):
        ahead = data[starts[order] + column]
        moved = np.argsort(ahead, kind="stable")
        order, symbols, common = order[moved], ahead[moved], common[moved]
        differ = (symbols[1:] != symbols[:-1]) | (common[1:] != common[:-1])
        common = np.r_[0, np.cumsum(differ)] if len(starts) else common
    return order, common


def smallest_ids(data: np.ndarray, starts: np.ndarray, ids: np.ndarray, width: int) -> np.ndarray:
    """Per string, the smallest id among the equal ones."""
    order, same = column_order(data, starts, width)
    least = np.full(int(same[-1]) + 1 if len(same) else 0, LAST, np.int64)
    np.minimum.at(least, same, ids[order])
    out = np.empty(len(starts), np.int64)
    out[order] = least[same]
    return out


def _return_found(width: int):
    def found(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        blocks = table.column("block").to_pylist()
        keys, firsts, strings, sizes = [], [], [], []
        for value in table.column("payload"):
            own, first, lengths, data = unpack_arrays(value.as_py())
            whole, ends = data.tobytes(), np.cumsum(lengths, dtype=np.int64)
            keys.append(np.cumsum(own, dtype=np.uint64))
            firsts.append(first)
            strings += [whole[b - n : b] for b, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
            sizes.append(len(own))
        places: dict[bytes, int] = {}
        at = np.array([places.setdefault(s, len(places)) for s in strings], np.int64)
        first, key = np.full(len(places), LAST, np.int64), np.zeros(len(places), np.uint64)
        np.minimum.at(first, at, np.concatenate(firsts))
        key[at] = np.concatenate(keys)
        distinct = list(places)
        del strings, places
        # a minimiser with one stretch needs no comparison; the others are compared string by string
        order = np.argsort(key, kind="stable")
        groups = np.split(order, np.flatnonzero(key[order][1:] != key[order][:-1]) + 1)
        several: dict[int, np.ndarray] = {}
        held: list[int] = []
        weight = 0

        def compare() -> None:
            counts = np.array([len(distinct[i]) - width + 1 for i in held], np.int64)
            data = np.frombuffer(b"".join(distinct[i] for i in held), np.uint8)
            begin = np.cumsum(counts + width - 1) - (counts + width - 1)
            ends = np.cumsum(counts)
            inside = np.arange(counts.sum()) - np.repeat(ends - counts, counts)
            least = smallest_ids(data, np.repeat(begin, counts) + inside, np.repeat(first[held], counts), width)
            for i, a, b in zip(held, (ends - counts).tolist(), ends.tolist(), strict=True):
                several[i] = least[a:b]

        for group in groups:
            if len(group) > 1:
                held += group.tolist()
                weight += sum(len(distinct[i]) for i in group.tolist())
            if weight > ORDERED:
                compare()
                held, weight = [], 0
        if held:
            compare()
        # answers as runs of equal ids, in the order the block has sent
        rows, a = [], 0
        for block, n in zip(blocks, sizes, strict=True):
            runs, lengths, ids = [], [], []
            for i in at[a : a + n].tolist():
                own = several.get(i)
                if own is None:
                    runs.append(1)
                    lengths.append(len(distinct[i]) - width + 1)
                    ids.append(int(first[i]))
                else:
                    cut = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                    runs.append(len(cut))
                    lengths += np.diff(np.r_[cut, len(own)]).tolist()
                    ids += own[cut].tolist()
            a += n
            rows.append((block, part, FOUND, pack_arrays(np.array(runs, np.uint32), np.array(lengths, np.uint32), np.array(ids, np.int64))))
        return _messages(rows)

    return found


def _cut(width: int):
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))

    def cut(docs: pa.Table, messages: pa.Table) -> pa.Table:
        block = Block(docs, width)
        marks = np.zeros(len(block.data) + 1, np.int32)
        if messages.num_rows:
            strings, _, at, starts, counts = block.shared(*_common_of(messages))
            answers = sorted(
                (p, v)
                for p, k, v in zip(messages.column("part").to_pylist(), messages.column("kind").to_pylist(), messages.column("payload").to_pylist(), strict=True)
                if k == FOUND
            )
            if answers:
                runs, lengths, ids = (np.concatenate(x) for x in zip(*(unpack_arrays(v) for _, v in answers), strict=True))
                runs, lengths = runs.astype(np.int64), lengths.astype(np.int64)
                begin = np.cumsum(runs) - runs
                within = np.cumsum(lengths) - lengths
                within -= np.repeat(within[begin], runs)
                # every run of every occurrence
                many = runs[at]
                run = np.repeat(begin[at], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                owner = block.ids[np.searchsorted(block.ends, starts, side="right")]
                gone = ids[run] < np.repeat(owner, many)
                first = (np.repeat(starts, many) + within[run])[gone]
                last = first + lengths[run][gone] - 1 + width
                marks += np.bincount(first, minlength=len(marks)).astype(np.int32)
                marks -= np.bincount(last, minlength=len(marks)).astype(np.int32)
        covered = np.cumsum(marks[:-1]) > 0
        kept, sizes, removed, spans = [], [], [], []
        begins = np.r_[0, block.ends[:-1]].tolist()
        for a, b, text in zip(begins, block.ends.tolist(), block.texts, strict=True):
            own = covered[a:b]
            gone = int(np.count_nonzero(own))
            sizes.append(b - a)
            removed.append(gone)
            if not gone:
                kept.append(text)
                spans.append([])
                continue
            edges = np.flatnonzero(np.diff(np.r_[False, own, False].astype(np.int8)))
            spans.append([{"start": s, "length": e - s} for s, e in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)])
            kept.append(block.data[a:b][~own].tobytes())
        rest = docs.column("rest").combine_chunks().take(pa.array(block.rows, pa.int64()))
        columns = [rest, pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, spans_type)]
        return pa.table(columns, names=["rest", "kept", "n_bytes", "n_removed", "spans"])

    return cut


def remove_repeats(
    docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, crowd: int = CROWD
) -> DataFrame:
    """(rest, kept, n_bytes, n_removed, spans) per document.

    ``rest`` is a struct with all columns but the text, ``kept`` the bytes that stay,
    ``spans`` the maximal runs that were removed (start and length in bytes).
    """
    if width < ANCHOR:
        raise ValueError(f"width must be at least {ANCHOR}")
    spark = docs.sparkSession
    ship(spark)
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    named = F.xxhash64(F.col(id_col).cast("long"), text)
    weighed = docs.groupBy(named.alias("named")).agg(F.sum(F.octet_length(text)).alias("bytes"), F.count("*").alias("n"))
    heavy = F.when((F.col("n") > 1) & (F.col("bytes") + F.col("n") * ROW_BYTES > block_bytes), F.col("named"))
    # at most as many as there are blocks' weights in the table
    total, spread = weighed.agg(F.sum("bytes"), F.collect_list(heavy)).first()
    total = total or 0
    blocks = max(1, -(-total // block_bytes))
    parts = max(1, -(-blocks // BLOCKS_PER_PART))
    rest = F.struct(*[F.col(c) for c in docs.columns if c != text_col])
    # equal ids never remove each other's bytes, in whatever blocks they are
    place = F.when(named.isin(spread), F.xxhash64(F.monotonically_increasing_id())).otherwise(named) if spread else named
    block = F.pmod(place, F.lit(blocks)).cast("int")
    dealt = docs.select(rest.alias("rest"), F.col(id_col).cast("long").alias("id"), text.alias("text"), block.alias("block"))
    name, path = f"suffix_blocks_{uuid.uuid4().hex}", shared_path(spark, "blocks")
    dealt.repartition(blocks, "block").write.bucketBy(blocks, "block").option("compression", "zstd").option("path", path).saveAsTable(name)
    staged = spark.table(name)
    only = staged.select("block", "id", "text")

    keys = only.groupBy("block").applyInArrow(_send_keys(width, parts), MESSAGES)
    common = stored(keys.groupBy("part").applyInArrow(_return_common(crowd), MESSAGES), "common")
    strings = only.groupBy("block").cogroup(common.groupBy("block")).applyInArrow(_send_strings(width, parts), MESSAGES)
    found = stored(strings.groupBy("part").applyInArrow(_return_found(width), MESSAGES), "found")
    fields = [
        StructField("rest", staged.schema["rest"].dataType),
        StructField("kept", BinaryType()),
        StructField("n_bytes", LongType()),
        StructField("n_removed", LongType()),
        StructField("spans", ArrayType(StructType([StructField("start", LongType()), StructField("length", LongType())]))),
    ]
    both = common.unionByName(found)
    result = staged.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(_cut(width), StructType(fields))
    result = stored(result, "kept")
    spark.sql(f"DROP TABLE {name}")
    remove_path(spark, path)
    return result
