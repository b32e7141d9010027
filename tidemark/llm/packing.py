"""Packing documents into sequences by exact-complement hashing.

Documents are tokenized once, cut into pieces, and only the pieces' digests travel on.  Which
lengths go together depends on the histogram of lengths alone, at most ``size`` numbers whatever
the data: ``plan`` fills it from the longest length down with the single, pair or triple whose
sum is exactly the gap, as often as availability counts allow, then packs what is left by best
fit.  A plan is a list of patterns, each with a count, so its size doesn't grow with the data.

A piece gets its place from its rank among pieces of its length.  Ranks come from counts of
(length, hash bucket), so a length that a third of the pieces share is spread over all buckets.
"""

from __future__ import annotations

import os
import struct
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import by_value, released, text_of, written

by_value(__name__)

SIZE = 2048
#: Hash buckets of a length; a length with 40 billion pieces makes 10 million rows in each.
BUCKETS = 4096
#: Bytes of the store of chunks' ids in a worker, about; it is emptied when it is full.  A chunk takes
#: its own bytes, its ids' and ENTRY more; none longer than LONGEST is kept.
KEPT, ENTRY, LONGEST = 40 << 20, 150, 256
#: What may stand behind a word: the tokenizer takes a run of these as one piece.
BEHIND = b"!\"#$%&()*+,-./:;=?@[\\]^_`{|}~"


def spelled(tok) -> dict[str, str]:
    """How the model reads each letter below U+0500, if a word of such letters is one piece to it,
    and what stands behind another."""
    def read(text: str) -> list[str]:
        text = tok.normalizer.normalize_str(text) if tok.normalizer else text
        return [piece for piece, _ in tok.pre_tokenizer.pre_tokenize_str(text)] if tok.pre_tokenizer else []

    letters = {c: r[0] for c in map(chr, range(0x500)) if c.isalpha() and len(r := read(c)) == 1}
    word, behind = "".join(letters), BEHIND.decode()
    return letters if read(word + behind) == ["".join(letters.values()), *read(behind)] else {}


def encoder(path: str):
    """texts -> their ids as bytes (little-endian unsigned 32-bit).

    The tokenizer never joins what white space parts, so the ids of a text are those of its
    chunks.  Chunks recur: their ids are kept, in a store of bounded size that later tasks of the
    same worker find again.  A new chunk of letters goes to the model at once, as it is one piece;
    with punctuation behind it is two chunks; any other goes through the whole tokenizer."""
    import tokenizers
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    loaded = tokenizers.__dict__.setdefault("_loaded", {})
    if path not in loaded:
        tok = tokenizers.Tokenizer.from_file(path)
        letters, model = spelled(tok), tok.model

        def ids_of(chunk: bytes) -> bytes:
            word = None
            try:
                word = "".join(map(letters.__getitem__, chunk.decode()))
            except KeyError:
                core = chunk.rstrip(BEHIND)
                if letters and core and core != chunk and letters.keys() >= set(core.decode()):
                    return kept[core] + kept[chunk[len(core):]]
            if word is None:
                ids = tok.encode(chunk.decode(), add_special_tokens=False).ids
            else:
                ids = [t.id for t in model.tokenize(word)]
            return struct.pack(f"<{len(ids)}I", *ids)

        class Kept(dict):
            held = 0

            def __missing__(self, chunk):
                ids = ids_of(chunk)
                if len(chunk) <= LONGEST:
                    if self.held > KEPT:
                        self.clear()
                        self.held = 0
                    self[chunk] = ids
                    self.held += len(chunk) + len(ids) + ENTRY
                return ids

        kept = Kept()
        loaded[path] = kept
    ids = loaded[path].__getitem__

    def encode(texts: list[str]) -> list[bytes]:
        # the tokenizer lowers case itself; special tokens are matched before it does
        return [b"".join(map(ids, (b if b"<|" in b else b.lower()).split())) for b in (t.encode() for t in texts)]

    return encode


def plan(count: dict[int, int], size: int = SIZE) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns (times, [(length, how many)]) that use up ``count`` (length -> pieces): the best of
    four plans, which look for exact complements of up to 0, 1, 2 and 3 pieces before best fit.
    Where long pieces abound, each takes a sequence anyway, and small ones are better kept for them."""
    plans = [complements(count, size, most) for most in (3, 2, 1, 0)]
    return min(plans, key=lambda p: sum(times for times, _ in p))


def complements(count: dict[int, int], size: int, most: int):
    """A plan that fills gaps exactly with up to ``most`` pieces where it can, by number of pieces
    and the longest length first, then fits what is left."""
    have = np.zeros(size + 1, np.int64)
    for length, n in count.items():
        have[length] = n
    out: list[tuple[int, list[tuple[int, int]]]] = []
    there = (have > 0).astype(np.int64)
    sums = np.convolve(there, there)  # index of pair sums: how many (x, y) in stock have each

    def take(lengths: list[int]) -> bool:
        items = sorted({x: lengths.count(x) for x in lengths}.items(), reverse=True)
        times = int(min(have[x] // k for x, k in items))
        if times:
            out.append((times, items))
            for x, k in items:
                have[x] -= times * k
                if not have[x]:
                    sums[x:x + size + 1] -= 2 * there
                    sums[2 * x] += 1
                    there[x] = 0
        return times > 0

    def single(gap: int, also: list[int]) -> bool:
        return bool(have[gap]) and take([*also, gap])

    def pair(gap: int, also: list[int]) -> bool:
        """The pair of the longest length first."""
        low = np.arange(1, gap // 2 + 1)
        return any(take([*also, int(gap - a), int(a)]) for a in low[(have[low] > 0) & (have[gap - low] > 0)])

    def triple(gap: int, also: list[int]) -> bool:
        first = np.arange(1, max(1, gap - 1))
        return any(pair(int(gap - b), [*also, int(b)]) for b in first[(have[first] > 0) & (sums[gap - first] > 0)][::-1])

    if have[size]:
        take([size])
    for find in (single, pair, triple)[:most]:
        for a in range(size - 1, 0, -1):
            while have[a] and find(size - a, [a]):
                pass
    fit(have, size, out)
    return out


def fit(have: np.ndarray, size: int, out: list) -> None:
    """Best fit, the longest first, of all pieces of a length at once.  ``open_`` holds the patterns
    begun, by gap: a length goes to the smallest gap it fits in; a pattern of which only some
    sequences get a piece is parted in two."""
    gaps: list[int] = []
    open_: dict[int, list[list]] = {}

    def put(gap: int, times: int, items: dict[int, int]) -> None:
        if gap not in open_:
            insort(gaps, gap)
        open_.setdefault(gap, []).append([times, items])

    for x in np.flatnonzero(have)[::-1]:
        x, left = int(x), int(have[x])
        while left:
            at = bisect_left(gaps, x)
            if at == len(gaps):
                k = min(size // x, left)
                put(size - k * x, left // k, {x: k})
                if left % k:
                    put(size - left % k * x, 1, {x: left % k})
                left = 0
                break
            gap = gaps[at]
            times, items = open_[gap].pop()
            if not open_[gap]:
                del open_[gap], gaps[at]
            k = min(gap // x, left)  # so many in each sequence: what is left fits no better elsewhere
            n = min(times, left // k)
            if n < times:
                put(gap, times - n, items)
            put(gap - k * x, n, items | {x: items.get(x, 0) + k})
            left -= n * k
        have[x] = 0
    out += [(times, sorted(items.items(), reverse=True)) for some in open_.values() for times, items in some]


def places(patterns) -> tuple[np.ndarray, ...]:
    """The plan by length and rank: key (length << 44 | first rank), first sequence, pieces of
    that length in a sequence, first offset."""
    rows, used, base = [], {}, 0
    for times, items in patterns:
        offset = 0
        for length, k in items:
            rows.append((length << 44 | used.get(length, 0), base, k, offset))
            used[length] = used.get(length, 0) + times * k
            offset += length * k
        base += times
    rows.sort()
    return tuple(np.array(c, np.int64) for c in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 4


def pieces(docs: DataFrame, tokenizer: str, size: int = SIZE, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every piece of every document."""
    fields = [pa.field("piece", pa.int32()), pa.field("start", pa.int64()), pa.field("length", pa.int64()),
              pa.field("ids_crc32", pa.int64())] + [pa.field("ids", pa.list_(pa.int32()))] * keep_ids

    def run(batches):
        encode = encoder(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                row, cols = [], [[] for _ in fields]
                for i, ids in enumerate(encode(part.column("text").to_pylist())):
                    ids += b"\0\0\0\0"
                    for k in range(0, len(ids), 4 * size):
                        one = ids[k:k + 4 * size]
                        row.append(i)
                        found = (k // (4 * size), k // 4, len(one) // 4, zlib.crc32(one))
                        for c, v in zip(cols, found):
                            c.append(v)
                        if keep_ids:
                            cols[4].append(np.frombuffer(one, "<i4"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(row, pa.int64())),
                     *(pa.array(c, f.type) for c, f in zip(cols, fields))],
                    ["doc_id", *(f.name for f in fields)])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(
        released(run), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
        + ", ids array<int>" * keep_ids)


def pack(docs: DataFrame, tokenizer: str, size: int = SIZE, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    Null or empty text: one piece of the id 0 alone.  Null doc_id: kept.  Repeated rows: packed
    each.  Empty table: empty result.  Other columns are ignored."""
    cut = written(pieces(docs, tokenizer, size, keep_ids).withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(BUCKETS)).cast("int")), "pack-pieces")
    shelves = written(cut.groupBy("length", "bucket").agg(F.count("*").alias("n")), "pack-shelves")
    # at most ``size`` rows
    patterns = plan({r["length"]: r["n"] for r in shelves.groupBy("length").agg(F.sum("n").alias("n")).collect()},
                    size)
    key, sequence, many, offset = places(patterns)
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = cut.withColumn("inside", F.row_number().over(inside)).join(
        shelves.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")),
        ["length", "bucket"])
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids

    def place(batches):
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            at = np.searchsorted(key, length << 44 | rank, "right") - 1
            inside = rank - (key[at] & ((1 << 44) - 1))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(sequence[at] + inside // many[at]),
                 pa.array(offset[at] + inside % many[at] * length)], [*names, "sequence_id", "offset"])

    kinds = ", ".join(f"{c} {ranked.schema[c].dataType.simpleString()}" for c in names)
    return ranked.select(*names, (F.col("before") + F.col("inside") - 1).cast("bigint").alias("rank")).mapInArrow(
        released(place), f"{kinds}, sequence_id long, offset long")
