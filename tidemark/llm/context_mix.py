"""Language-model scores by online logistic context mixing.

A text is its lower-cased words with one space between and one end, read byte by byte; every byte
is a few binary choices, the turns of a prefix code built from the corpus' counts of bytes after
the byte before, so likely letters cost few.  For each choice several predictors look up how it went in the training texts
after the same 3 or 4 bytes and after the same beginning of a word (hashed contexts).  Their log
odds, and a constant, are mixed by weights; which set of weights is used is gated by the depth in the code and by how
many of the long contexts were seen.  The weights go on learning along a text to its end, and an adaptive map refines the mix by how its
predictions have turned out there.  The sum over all choices is the text's probability.

Counts and weights cover all training texts.  These are read once to count them: a task sends each
context and byte after it once, with how often they met, by ranges of hashes; tasks after it add these up, and
slots get their counts from the sums, range by range.  The tables have
at least the slots of ``ORDERS`` and grow with the contexts measured in the corpus, so that these
don't share slots more as it grows.  Beside the model stands the base: word counts, exact for every word.  Scores
of the ``HEAD`` most frequent words are looked up in a table of that size; all other words meet
their counts in a join.
"""

from __future__ import annotations

import functools
import heapq
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import by_value, released, rest_of, text_of, written

by_value(__name__)

#: Contexts: so many bytes back, or (0) the word so far; and log2 of the least slots of their table.
ORDERS = ((3, 20), (4, 21), (0, 22))
SLOTS = sum(1 << bits for _, bits in ORDERS)
BITS = tuple(bits for _, bits in ORDERS)
PAD = max(k for k, _ in ORDERS)
#: Slots in a block, of which a task adds up some at a time (ADDED); slots the driver fetches at a time; of so many contexts one is measured.
BLOCK, FETCHED, MEASURED = 1024, 1 << 23, 256
ADDED = 512 * BLOCK
#: Bytes sorted by context at a time; contexts a task holds before it sends them; characters of all texts for each range of hashes.
SORTED, HELD, CELL = 1 << 21, 1 << 20, 1 << 23
#: Training texts that the fit of the weights begins with, about; those of over so many characters aren't drawn.
SAMPLE, DRAWN = 400, 1 << 18
#: Words whose counts go along with the model.
HEAD = 1 << 17
#: Bytes of a text between two updates; bytes of texts read at once.
STEP, AT_ONCE = 32, 1 << 20
#: Bytes whose contexts are made, and about as many whose choices are looked up, at once: their arrays stay in the cache.
PIECE, LOOKED_UP = 1 << 17, 1 << 14
DEPTHS, SEEN = 8, 3
GATES = DEPTHS * SEEN
BUCKETS = 32
ODDS_STEP = 9 / 127
RATE, MAP_RATE, BIAS = 0.02, 0.05, np.float32(0.3)
END = b"\n"
#: Hash of the end of a text; words of over so many bytes are hashed alone; words a task counts before it sends them.
END_HASH, LONG, WORDS = np.uint64(0x2545F4914F6CDD1D), 64, 1_000_000


class Code:
    """Prefix codes of bytes, one after each byte.  The choices on the path of a byte after another
    (``pair`` = 256 * other + byte) stand together, from ``first`` on: a key of their node, the
    turn taken and the gate of their depth."""

    def __init__(self, counts: np.ndarray):
        steps, self.length = [], np.zeros(256 * 256, np.int64)
        for other in range(256):
            paths = self.paths(counts[other].tolist())
            for b in range(256):
                self.length[256 * other + b] = len(paths[b])
                steps += [(other << 9 | node, turn) for node, turn in paths[b]]
        self.first = np.cumsum(self.length) - self.length
        self.node = np.array([n for n, _ in steps], np.uint32)
        self.key = (self.node + np.uint32(1)) * np.uint32(0x9E3779B1)
        self.key ^= self.key >> np.uint32(15)
        self.turn = np.array([t for _, t in steps], np.uint8)
        depth = np.arange(len(steps)) - np.repeat(self.first, self.length)
        self.gate = (np.minimum(depth, DEPTHS - 1) * SEEN).astype(np.uint8)

    @staticmethod
    def paths(counts: list[int]) -> dict[int, list[tuple[int, int]]]:
        heap = [(n, b, None) for b, n in enumerate(counts)]
        heapq.heapify(heap)
        names = iter(range(256, 512))
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            heapq.heappush(heap, (a[0] + b[0], next(names), (a, b)))
        found: dict[int, list[tuple[int, int]]] = {}
        stack, node = [(heap[0], [])], 0
        while stack:
            (_, name, sides), path = stack.pop()
            if sides is None:
                found[name] = path
                continue
            for turn, side in enumerate(sides):
                stack.append((side, [*path, (node, turn)]))
            node += 1
        return found


def normal(text: str) -> bytes:
    return b" ".join(text.encode().lower().split()) + END


def powers_of(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd number, and their inverses."""
    return first_powers() if n <= 2 * PIECE else made_powers(n)


def made_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    odd, out = 0x9E3779B97F4A7C15, []
    for x in (odd, pow(odd, -1, 1 << 64)):
        powers = np.full(n, np.uint64(x))
        powers[0] = 1
        out.append(np.cumprod(powers))
    return out[0], out[1]


@functools.lru_cache(1)
def first_powers() -> tuple[np.ndarray, np.ndarray]:
    return made_powers(2 * PIECE)


def contexts(texts: list[bytes]):
    """Bytes of many texts in order (as pairs with the byte before), a hash of each context for
    each, and where texts begin."""
    ends = np.cumsum([0, *map(len, texts)])
    # texts are parted by PAD end bytes, so that no context reaches into the text before
    data = np.frombuffer((END * PAD).join([b"", *texts]), np.uint8)
    n = len(data)
    at = np.arange(ends[-1]) + np.repeat(np.arange(1, len(texts) + 1) * PAD, np.diff(ends))
    wide, out, h = data.astype(np.uint32) + np.uint32(1), {}, np.zeros(n, np.uint32)
    for k in range(1, PAD + 1):
        h[k:] += wide[:n - k]
        h *= np.uint32(0x2F0B4C47)
        h ^= h >> np.uint32(15)
        out[k] = h.take(at)
    # the word so far: a polynomial over all bytes up to here less that up to the word's start,
    # brought to the same power
    powers, back = powers_of(n)
    upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(powers[:n] * wide)])
    starts = np.maximum.accumulate(np.where((data == 32) | (data == 10), np.arange(1, n + 1), 0)).take(at - 1)
    word = (upto.take(at) - upto.take(starts)) * back.take(starts) * np.uint64(0xD6E8FEB86659FD93)
    out[0] = (word >> np.uint64(32)).astype(np.uint32)
    return data.take(at - 1).astype(np.int64) << 8 | data.take(at), [out[k] for k, _ in ORDERS], ends


def read_bytes(texts: list[bytes]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Bytes and hashes as of ``contexts``, made piece by piece."""
    pieces = [contexts(some)[:2] for some in grouped(texts, PIECE)]
    return (np.concatenate([byte.astype(np.uint16) for byte, _ in pieces]),
            [np.concatenate([hashes[k] for _, hashes in pieces]) for k in range(len(ORDERS))])


def bases(bits: tuple[int, ...]) -> np.ndarray:
    """Where tables of these sizes begin, one after another, and where the last ends."""
    return np.cumsum([0, *(1 << b for b in bits)])


def slots_of(bits: int, h: np.ndarray, length: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Slots, of 2 ** ``bits``, of the choices of bytes with context hashes ``h``."""
    return placed(bits, np.repeat(h, length), key)


def placed(bits: int, s: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Context hashes of choices, ``s``, made their slots."""
    s += key
    s *= np.uint32(0x85EBCA6B)
    s >>= np.uint32(32 - bits)
    return s


def path_of(pair: np.ndarray, code: Code) -> tuple[np.ndarray, np.ndarray]:
    """For bytes: their choices' places in the code, and how many each has."""
    length = code.length[pair]
    start = np.cumsum(length) - length
    return np.repeat(code.first[pair] - start, length) + np.arange(int(length.sum())), length


def grouped(texts: list[bytes], at_once: int = AT_ONCE):
    """Runs of texts of about ``at_once`` bytes; a longer text is alone."""
    run, size = [], 0
    for t in texts:
        if run and size + len(t) > at_once:
            yield run
            run, size = [], 0
        run.append(t)
        size += len(t)
    if run:
        yield run


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, in order, and the sum of its ``counts`` (or of its rows of them)."""
    order = np.argsort(keys, kind="stable")  # merges what is in order
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts[order], first, axis=0) if len(first) else counts[:0]


def grams(docs: DataFrame, parts: int = 1) -> DataFrame:
    """How often each byte followed each context in the texts of each part of ``docs`` (text, and
    ``fitted``, a text's part, where there is more than one).  Texts are read once, however large
    the tables are: a task sorts its bytes by context and sends each context and byte once, a task
    after it adds up those of a range of hashes.

    A row holds for table k those of a range (cell) of hashes: ``keys``, 64-bit, hash and pair of
    bytes, in order, and ``counts``, 64-bit, of each key in each part."""
    part = F.col("fitted").cast("int") if "fitted" in docs.columns else F.lit(0)
    docs = docs.select("text", part.alias("part"))
    size = docs.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    bits = max(4, (int(size) // CELL).bit_length())

    def sent(k, part, held):
        keys, counts = summed(*map(np.concatenate, zip(*held))) if len(held) > 1 else held[0]
        cells = keys >> np.uint64(48 - bits)
        cuts = np.flatnonzero(np.diff(cells, prepend=np.uint64(1 << bits)))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(cuts), k, np.int32)), pa.array(cells[cuts].astype(np.int32)), pa.array(np.full(len(cuts), part, np.int32)),
             *(pa.array([x.tobytes() for x in np.split(y, cuts[1:])], pa.binary()) for y in (keys, counts))], ["k", "cell", "part", "keys", "counts"])

    def count(batches):
        held: dict[tuple[int, int], list] = {}
        n = 0
        for p, texts in by_part(batches):
            byte, hashes = read_bytes(texts)
            for k, h in enumerate(hashes):
                keys = h.astype(np.uint64)
                keys <<= np.uint64(16)
                keys |= byte
                keys.sort()
                first = np.flatnonzero(np.concatenate([np.ones(1, bool), keys[1:] != keys[:-1]]))
                held.setdefault((k, p), []).append((keys[first], np.diff(first, append=len(keys))))
                n += len(first)
            if n > HELD:
                for (k, q), some in held.items():
                    yield sent(k, q, some)
                held, n = {}, 0
        for (k, q), some in held.items():
            yield sent(k, q, some)

    def by_part(batches):
        """Runs of texts of one part, of about SORTED bytes, as far as there are so many."""
        own: dict[int, list[bytes]] = {}
        sizes: Counter = Counter()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                for t, p in zip(some.column("text").to_pylist(), some.column("part").to_pylist()):
                    t = normal(t)
                    if sizes[p] and sizes[p] + len(t) > SORTED:
                        yield p, own.pop(p)
                        sizes[p] = 0
                    own.setdefault(p, []).append(t)
                    sizes[p] += len(t)
        yield from own.items()

    def add(batches):
        held: dict[tuple[int, int], list] = {}
        for batch in batches:
            for k, cell, p, keys, n in zip(*(batch.column(c).to_pylist() for c in ("k", "cell", "part", "keys", "counts"))):
                keys = np.frombuffer(keys, np.uint64)
                counts = np.zeros((len(keys), parts), np.int64)
                counts[:, p] = np.frombuffer(n, np.int64)
                some = held.setdefault((k, cell), [])
                some.append((keys, counts))
                if len(some) > 1 and sum(len(x) for x, _ in some[1:]) > max(1 << 16, len(some[0][0])):
                    some[:] = [summed(*map(np.concatenate, zip(*some)))]
        for (k, cell), some in held.items():
            keys, counts = summed(*map(np.concatenate, zip(*some)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), pa.array([cell], pa.int32()), pa.array([keys.tobytes()], pa.binary()),
                 pa.array([counts.tobytes()], pa.binary())], ["k", "cell", "keys", "counts"])

    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 << bits)
    return written(docs.mapInArrow(released(count), "k int, cell int, part int, keys binary, counts binary")
                   .repartition(tasks, "k", "cell").mapInArrow(released(add), "k int, cell int, keys binary, counts binary"), "lm-grams")


def grams_of(docs: DataFrame, parts: int = 1) -> DataFrame:
    """``docs`` if they are grams already, else theirs."""
    return docs if "keys" in docs.columns else grams(docs, parts)


def opened(batch: pa.RecordBatch, parts: int | None = None):
    """Of each row of grams: k, hashes, pairs of bytes and counts."""
    for k, keys, n in zip(batch.column("k").to_pylist(), batch.column("keys"), batch.column("counts")):
        keys, n = np.frombuffer(keys.as_buffer(), np.uint64), np.frombuffer(n.as_buffer(), np.int64)
        yield k, (keys >> np.uint64(16)).astype(np.uint32), (keys & np.uint64(0xFFFF)).astype(np.int64), n.reshape(len(keys), -1)


def pair_counts(docs: DataFrame) -> np.ndarray:
    """How often each byte follows each other, 256 x 256, in all of ``docs`` (texts, or their grams)."""
    def run(batches):
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for _, _, pair, n in opened(batch):
                np.add.at(total, pair, n.sum(1))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["pair", "n"])

    out = np.zeros(1 << 16, np.int64)
    some = grams_of(docs).where("k = 0")  # each byte is once in each table
    for r in some.mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        out[r["pair"]] = r["n"]
    return out.reshape(256, 256)


def table_bits(docs: DataFrame, code: Code, least: tuple[int, ...] = BITS) -> tuple[int, ...]:
    """log2 of the slots each table needs, so that there are no fewer than choices after different
    contexts in ``docs`` (texts, or their grams): those of every MEASURED-th context, by hash, are counted."""
    def run(batches):
        total = np.zeros((len(least), 1 << 16), np.int64)
        for batch in batches:
            for k, h, pair, _ in opened(batch):
                # hashes of other bits than the slot takes
                some = (h * np.uint32(0xC2B2AE35)) >> np.uint32(16) & np.uint32(MEASURED - 1) == 0
                total[k] += np.bincount(pair[some], minlength=1 << 16)
        for k, n in enumerate(total):
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), pa.array(at.astype(np.int32)), pa.array(n[at])],
                                             ["k", "pair", "n"])

    choices = np.zeros(len(least))
    seen = grams_of(docs).mapInArrow(run, "k int, pair int, n long").groupBy("k", "pair").agg(F.sum("n").alias("n"))
    for r in seen.collect():  # at most a row per table and pair of bytes
        choices[r["k"]] += MEASURED * r["n"] * int(code.length[r["pair"]])
    return tuple(max(b, min(32, int(np.ceil(np.log2(max(1.0, c)))))) for b, c in zip(least, choices))


def context_odds(docs: DataFrame, code: Code, bits: tuple[int, ...] = BITS, counted: int = ADDED, parts: int = 2) -> list[np.ndarray]:
    """Log odds of each slot: how often its choice went 1 and 0 in all of ``docs`` (text, fitted; or
    their grams in ``parts``), then the same without the texts of each part: ``fitted`` is a text's
    part, 0 to ``parts`` - 1.  A task adds up ``counted`` slots at a time, so its memory stays bounded."""
    starts = bases(bits)
    slots = int(starts[-1])

    def choices(batches):
        for batch in batches:
            for k, h, pair, n in opened(batch):
                for at in range(0, len(h), 1 << 17):
                    some = pair[at:at + (1 << 17)]
                    place, length = path_of(some, code)
                    s = slots_of(bits[k], h[at:at + (1 << 17)], length, code.key[place]).astype(np.int64) + starts[k]
                    s <<= 1
                    s |= code.turn[place]
                    of = np.repeat(np.arange(at, at + len(some)), length)
                    for p in range(parts):
                        m = n[of, p]
                        here = np.flatnonzero(m)
                        if len(here):
                            yield sent(p, s[here], m[here])

    def sent(part, s, m):
        low = s // (2 * counted)
        order = np.argsort(low.astype(np.uint16) if slots // counted < 1 << 16 else low, kind="stable")
        low, s, m = low[order], s[order], m[order]
        s -= low * (2 * counted)
        cuts = np.flatnonzero(np.diff(low, prepend=-1))
        return pa.RecordBatch.from_arrays(
            [pa.array(low[cuts].astype(np.int32)), pa.array(np.full(len(cuts), part, np.int32)),
             *(pa.array([x.tobytes() for x in np.split(y, cuts[1:])], pa.binary()) for y in (s.astype(np.uint32), m))], ["block", "part", "slots", "counts"])

    names = [f"odds{k}" for k in range(parts + 1)]

    def add(batches):
        held: dict[int, np.ndarray] = {}  # by block: counts of each part
        for batch in batches:
            for b, p, s, m in zip(*(batch.column(c).to_pylist() for c in ("block", "part", "slots", "counts"))):
                if b not in held:
                    held[b] = np.zeros((parts, 2 * min(counted, slots - b * counted)), np.int64)
                np.add.at(held[b][p], np.frombuffer(s, np.uint32).astype(np.intp), np.frombuffer(m, np.int64))
        while held:
            b, n = held.popitem()
            whole = n.sum(0)
            odds = [log_odds(c.reshape(-1, 2)).tobytes() for c in (whole, *(whole - own for own in n))]
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), *(pa.array([x], pa.binary()) for x in odds)], ["block", *names])

    blocks = -(-slots // counted)
    # a task adds up a block, or about one
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), blocks)
    table = written(grams_of(docs, parts).mapInArrow(released(choices), "block int, part int, slots binary, counts binary")
                     .repartition(tasks, "block").mapInArrow(released(add), "block int, " + ", ".join(f"{n} binary" for n in names)), "lm-odds")
    out = [np.zeros(slots, np.int8) for _ in names]
    step = max(1, FETCHED // counted)
    for low in range(0, blocks, step):
        for r in table.where(F.col("block").between(low, low + step - 1)).toArrow().to_batches():
            for k, n in enumerate(names):
                for b, c in zip(r.column("block").to_pylist(), r.column(n)):
                    odds = np.frombuffer(c.as_buffer(), np.int8)
                    out[k][b * counted:b * counted + len(odds)] = odds
    return out


def log_odds(counts: np.ndarray) -> np.ndarray:
    """Of each slot, in steps of ODDS_STEP (a byte each, so that tables stay in the cache); 0 where
    nothing was seen."""
    n0, n1 = counts[:, 0].astype(np.float32), counts[:, 1].astype(np.float32)
    odds = np.clip(np.log(n1 + np.float32(0.2)) - np.log(n0 + np.float32(0.2)), -9, 9)
    return np.rint(odds / ODDS_STEP).astype(np.int8)


def first_map() -> np.ndarray:
    """Where the refining map starts: at what the mix says."""
    middle = (np.arange(BUCKETS, dtype=np.float32) + 0.5) / BUCKETS * 16 - 8
    return (1 / (1 + np.exp(-middle))).astype(np.float32)


def mixed(texts: list[bytes], code: Code, odds: np.ndarray, weights: np.ndarray, bits_of: tuple[int, ...] = BITS, scored: bool = True):
    """Log2 probability of each text (0 unless ``scored``: the weights alone don't need it), and the
    mean of the weights after each text.

    Texts learn side by side, each with weights and a map of its own from its beginning to its
    end.  They are read STEP bytes at a time, and what these showed is learned before the next;
    what doesn't depend on that is looked up for several such rounds at once.
    The longest are the first lanes, so that those still read are always the first ones."""
    f = np.float32
    size = np.array(list(map(len, texts)))
    longest = np.argsort(-size, kind="stable")
    lanes, size = len(texts), size[longest]
    byte, hashes = read_bytes([texts[i] for i in longest])
    ends = np.cumsum([0, *size])
    rounds = int(size[0]) // -STEP * -1
    inside = np.arange(len(byte)) - np.repeat(ends[:-1], size)
    round_ = inside // STEP
    if rounds <= 1 << 16:
        round_ = round_.astype(np.uint16)  # sorted by its digits
    order = np.argsort(round_, kind="stable")
    cuts = np.concatenate([[0], np.cumsum(np.bincount(round_, minlength=rounds))]).tolist()
    alive = np.searchsorted(-size, -STEP * np.arange(rounds)).tolist()  # lanes of over so many bytes
    begins = np.flatnonzero((inside % STEP == 0)[order])  # each lane's bytes in each round
    byte, hashes, lane = byte.take(order), [h.take(order) for h in hashes], np.repeat(np.arange(lanes), size).take(order)
    starts_of = bases(bits_of)
    tables = [odds[a:b] for a, b in zip(starts_of, starts_of[1:])]
    # weights are held times the step of what they weigh
    scale = np.array([ODDS_STEP] * len(tables) + [BIAS], f)
    w = [np.tile(weights[:, k] * scale[k], lanes) for k in range(weights.shape[1])]
    *_, rate, rate_of_bias = (RATE * scale.astype(np.float64) ** 2).astype(f)
    refine, bits = np.tile(first_map(), lanes), np.zeros(lanes)
    low, high, least, most, mix, map_, cell_of, middle, one = map(f, (-8, 7.99, 1 / 8192, 1 - 1 / 8192, 0.6, 0.4, BUCKETS / 16, BUCKETS / 2, 1))
    r = said = 0
    while r < rounds:
        last = max(r + 1, int(np.searchsorted(cuts, cuts[r] + LOOKED_UP, "right")) - 1)
        a, b = cuts[r], cuts[last]
        length = code.length.take(byte[a:b])
        upto = np.concatenate([[0], np.cumsum(length)])
        of = np.repeat(np.arange(b - a), length)
        place = (code.first.take(byte[a:b]) - upto[:-1]).take(of)
        place += np.arange(len(place))
        key, turns, gate = code.key.take(place), code.turn.take(place), code.gate.take(place)
        seen = []
        for k, (t, h) in enumerate(zip(tables, hashes)):
            s = placed(bits_of[k], h[a:b].take(of), key)
            # indices are machine integers: of any other kind, each use would convert them
            found = t.take(s.astype(np.intp), mode="wrap")
            if k >= len(tables) - 2:
                gate += (found != 0).view(np.uint8)
            seen.append(found.astype(f))
        gates = (lane[a:b] * GATES).take(of)
        gates += gate
        ys = turns.astype(f)
        if scored:
            seats = (lane[a:b] * (2 * BUCKETS)).take(of)
            seats += turns
        for i in range(r, last):
            c, d, live = upto[cuts[i] - a], upto[cuts[i + 1] - a], alive[i]
            g, y, x = gates[c:d], ys[c:d], [xk[c:d] for xk in seen]
            z = w[-1].take(g)
            for xk, wk in zip(x, w):
                t = wk.take(g)
                t *= xk
                z += t
            if scored:
                np.maximum(z, low, out=z)
                np.minimum(z, high, out=z)
                np.multiply(z, cell_of, out=t)
                t += middle
                cell = t.astype(np.intp)
                cell *= 2
                cell += seats[c:d]
                q = refine.take(cell >> 1)
            else:
                np.clip(z, low, high, out=z)
            np.negative(z, out=z)
            np.exp(z, out=z)
            z += one
            p = np.reciprocal(z, out=z)
            if scored:
                q *= map_
                np.multiply(p, mix, out=t)
                q += t
                np.maximum(q, least, out=q)
                np.minimum(q, most, out=q)
                np.subtract(one, q, out=t)
                t -= y
                np.abs(t, out=t)  # q where y is 1, else 1 - q
                lanes_at = upto.take(begins[said:said + live] - a) - c
                said += live
                product = np.multiply.reduceat(t.astype(np.float64), lanes_at)
                if product.min() > 1e-290:
                    bits[:live] += np.log2(product)
                else:  # too small to multiply
                    bits[:live] += np.add.reduceat(np.log2(t), lanes_at, dtype=np.float64)
            miss = np.subtract(y, p, out=p)
            np.multiply(miss, rate_of_bias, out=t)
            np.add.at(w[-1], g, t)
            miss *= rate
            for xk, wk in zip(x, w):
                np.multiply(miss, xk, out=t)
                np.add.at(wk, g, t)
            if scored:
                went = np.bincount(cell, minlength=2 * live * BUCKETS).astype(f).reshape(-1, 2)
                n = went[:, 0] + went[:, 1]
                now = refine[:live * BUCKETS]
                now += MAP_RATE * (went[:, 1] - n * now) / (1 + MAP_RATE * n)
        r = last
    out = np.empty(lanes)
    out[longest] = bits
    return out, (np.stack(w, 1).reshape(lanes, *weights.shape) / scale).mean(0)


class Model:
    """Code, log odds and first weights: all a worker needs."""

    def __init__(self, code: Code, odds: np.ndarray, weights: np.ndarray, bits: tuple[int, ...] = BITS):
        # weights without one of the constant: none at first
        weights = np.pad(weights, ((0, 0), (0, len(ORDERS) + 1 - weights.shape[1])))
        self.code, self.odds, self.weights, self.bits = code, odds, weights, bits

    def score(self, texts: list[str | bytes]) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability and bytes of each text; bytes are those of a text made ``normal``."""
        data = [t if isinstance(t, bytes) else normal(t) for t in texts]
        # texts of like lengths are read together, so that few rounds have few texts left
        order = sorted(range(len(data)), key=lambda i: -len(data[i]))
        bits = [mixed(run, self.code, self.odds, self.weights, self.bits)[0] for run in grouped([data[i] for i in order])]
        out = np.zeros(len(data))
        out[order] = np.concatenate([np.zeros(0), *bits])
        return out * np.log10(2), np.array(list(map(len, data)))


def fit_on_all(texts: DataFrame, code: Code, without: list[np.ndarray], weights: np.ndarray, bits: tuple[int, ...]) -> np.ndarray:
    """First weights: the mean of those after each of all ``texts`` (text, part), which begin with
    ``weights`` and learn to the text's end by the counts ``without`` the texts of its part."""
    total, n = np.zeros(weights.shape), 0
    small = cloudpickle.dumps((code, weights, bits))
    for part, odds in enumerate(without):
        model = texts.sparkSession.sparkContext.broadcast((small, odds))

        def run(batches, model=model):
            small, odds = model.value
            code, weights, bits = cloudpickle.loads(small)
            total, n = np.zeros(weights.shape), 0
            for whole in batches:
                for at in range(0, whole.num_rows, 4000):
                    data = sorted(map(normal, whole.slice(at, 4000).column("text").to_pylist()), key=len, reverse=True)
                    for some in grouped(data):
                        total += len(some) * mixed(some, code, odds, weights, bits, False)[1].astype(np.float64)
                        n += len(some)
            if n:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary()), pa.array([n])], ["total", "n"])

        # a row a task
        for r in texts.where(F.col("part") == part).select("text").mapInArrow(released(run), "total binary, n long").collect():
            total += np.frombuffer(r["total"]).reshape(total.shape)
            n += r["n"]
        model.destroy()
    return (total / n).astype(np.float32) if n else weights


def train(learned: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of ``learned`` (doc_id, text): counts of all, and weights fitted on all.

    A small sample of whole texts, by counts of the others, says where the fit begins: equal rows
    are drawn together and taken once.  Then every text is fitted on, by the counts of other parts."""
    texts = learned.select(text_of().alias("text"), F.xxhash64(F.lit("fit"), "doc_id", text_of()).alias("h"))
    share = min(0.2, sample / max(1, texts.count()))
    drawn = (F.pmod("h", F.lit(1 << 30)) < int(share * (1 << 30))) & (F.length("text") <= DRAWN)
    part = F.when(drawn, 1).when(F.pmod(F.shiftright("h", 32), F.lit(2)) == 0, 0).otherwise(2)
    texts = texts.select("text", "h", part.alias("part"))
    counts = grams(texts.select("text", F.col("part").alias("fitted")), parts=3)
    code = Code(pair_counts(counts) * 256 + 1)
    bits = table_bits(counts, code)
    odds, *without = context_odds(counts, code, bits, parts=3)
    # a bounded sample comes to the driver
    first = texts.where("part = 1").dropDuplicates(["h"]).orderBy("h").limit(2 * sample)
    some = [normal(r["text"]) for r in first.select("text").collect()]
    weights = np.full((GATES, len(ORDERS) + 1), 0.3, np.float32)
    for _ in range(8 if some else 0):
        for run in grouped(some):
            weights = mixed(run, code, without[1], weights, bits)[1].astype(np.float32)
    return Model(code, odds, fit_on_all(texts.select("text", "part"), code, without, weights, bits), bits)


@functools.lru_cache(1)
def letters() -> np.ndarray:
    """A random 64-bit number for each byte."""
    return np.random.default_rng(64).integers(0, 1 << 64, 256, np.uint64)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each token of normal texts (words and, for each text, its end), and the
    number of each token's text.  Words of up to LONG bytes: a polynomial over random numbers of
    their bytes, all at once; polynomials of longer ones may meet, so these are hashed one by one."""
    if sum(map(len, texts)) > PIECE and len(texts) > 1:
        runs = list(grouped(texts, PIECE))
        before = np.cumsum([0, *map(len, runs)])
        h, of = zip(*map(word_hashes, runs))
        return np.concatenate(h), np.concatenate([o + b for o, b in zip(of, before)])
    import xxhash
    joined = b"".join(texts)
    data = np.frombuffer(joined, np.uint8)
    powers, back = powers_of(len(data))
    upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(powers[:len(data)] * letters().take(data))])
    gaps = np.flatnonzero((data == 32) | (data == 10))  # one after each word; an end's is its own
    starts = np.concatenate([[0], gaps[:-1] + 1])
    h = (upto.take(gaps) - upto.take(starts)) * back.take(starts)
    for k in np.flatnonzero(gaps - starts > LONG):
        h[k] = xxhash.xxh3_64_intdigest(joined[starts[k]:gaps[k]])
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    ends = data.take(gaps) == 10
    of = np.cumsum(ends) - ends
    words = gaps > starts  # an empty text has none
    return (np.concatenate([h[words], np.full(len(texts), END_HASH)]).view(np.int64),
            np.concatenate([of[words], np.arange(len(texts))]))


def word_counts(learned: DataFrame) -> DataFrame:
    """h, c: the count of every distinct token (by a 64-bit hash) of ``learned`` (text)."""
    def run(batches):
        held, n = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                for texts in grouped([normal(t) for t in batch.slice(at, 1000).column("text").to_pylist()]):
                    h = np.sort(word_hashes(texts)[0])
                    first = np.flatnonzero(np.concatenate([np.ones(1, bool), h[1:] != h[:-1]]))
                    held.append((h[first], np.diff(first, append=len(h))))
                    n += len(first)
                    if n > 2 * WORDS:
                        held = [summed(*map(np.concatenate, zip(*held)))]
                        n = len(held[0][0])
                        if n > WORDS:
                            yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], ["h", "c"])
                            held, n = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in summed(*map(np.concatenate, zip(*held)))], ["h", "c"])

    return (learned.select(text_of().alias("text")).mapInArrow(released(run), "h long, c long")
            .groupBy("h").agg(F.sum("c").alias("c")))


def score_texts(docs: DataFrame, held_out: Column | None = None, sample: int = SAMPLE, head: int = HEAD) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored): doc_id, held_out,
    n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.  ``held_out`` tells the rows
    not to learn from: those whose crc32(doc_id) mod 7 is 2.

    Null and empty texts: the end alone.  Repeated rows: scored each.  Nothing to learn from: the
    base is that of no counts, the model's choices are even but for what it learns along a text.
    Empty table: empty result."""
    held_out = rest_of(F.col("doc_id"), 7) == 2 if held_out is None else held_out
    rows = docs.select("doc_id", held_out.alias("held_out"), text_of().alias("text"))
    learned = rows.filter(~F.col("held_out"))
    words = written(word_counts(learned), "lm-words")
    total = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n, v = total["n"], total["v"]
    top = words.orderBy(F.desc("c"), "h").limit(head).toArrow()
    by_hash = np.argsort(top.column("h").to_numpy())
    head_h, head_c = (top.column(c).to_numpy()[by_hash].astype(np.int64) for c in ("h", "c"))
    # classes of this package are shipped by value: executors may have no copy of it
    trained = train(learned, sample)
    small = cloudpickle.dumps((trained.code, trained.weights, trained.bits))
    model = docs.sparkSession.sparkContext.broadcast((small, trained.odds, head_h, np.log10(head_c + 1.0)))

    def run(batches):
        small, odds, heads, logs = model.value
        code, weights, bits = cloudpickle.loads(small)
        lm = Model(code, odds, weights, bits)
        for whole in batches:
            for at in range(0, whole.num_rows, 4000):
                batch = whole.slice(at, 4000)
                data = [normal(t) for t in batch.column("text").to_pylist()]
                score, size = lm.score(data)
                sums, known, tokens, rare, often = [], [], [], [], []
                for texts in grouped(data):
                    h, of = word_hashes(texts)
                    k = np.minimum(np.searchsorted(heads, h), len(heads) - 1)
                    hit = heads[k] == h if len(heads) else np.zeros(len(h), bool)
                    sums.append(np.bincount(of[hit], logs[k[hit]], len(texts)))
                    known.append(np.bincount(of[hit], minlength=len(texts)))
                    tokens.append(np.bincount(of, minlength=len(texts)))
                    order = np.lexsort((h[~hit], of[~hit]))
                    h, of = h[~hit][order], of[~hit][order]
                    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(h)), bool), (h[1:] != h[:-1]) | (of[1:] != of[:-1])]))
                    cuts = np.searchsorted(of[first], np.arange(1, len(texts)))
                    rare += np.split(h[first], cuts)
                    often += np.split(np.diff(first, append=len(h)), cuts)
                sums, known, tokens = map(np.concatenate, (sums, known, tokens))
                ends = pa.array(np.cumsum([0, *map(len, rare)]), pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, np.int64), *x]))) for x in (rare, often)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), batch.column("doc_id"), batch.column("held_out"), pa.array(tokens, pa.int64()),
                     pa.array(known, pa.int64()), pa.array(sums, pa.float64()), pa.array(score, pa.float64()),
                     pa.array(-score / np.log10(2) / np.maximum(1, size), pa.float64()), *lists],
                    ["row", "doc_id", "held_out", "n_tokens", "known", "sums", "score", "bits_per_byte", "rare", "often"])

    kinds = T.StructType([T.StructField("row", T.LongType()), docs.schema["doc_id"], T.StructField("held_out", T.BooleanType()),
                          T.StructField("n_tokens", T.LongType()), T.StructField("known", T.LongType()),
                          T.StructField("sums", T.DoubleType()), T.StructField("score", T.DoubleType()),
                          T.StructField("bits_per_byte", T.DoubleType()), T.StructField("rare", T.ArrayType(T.LongType())),
                          T.StructField("often", T.ArrayType(T.LongType()))])
    scored = written(rows.withColumn("row", F.monotonically_increasing_id())
                     .select("row", "doc_id", "held_out", "text").mapInArrow(released(run), kinds), "lm-scored")
    rest = (scored.select("row", F.explode(F.arrays_zip("rare", "often")).alias("t"))
            .select("row", F.col("t.rare").alias("h"), F.col("t.often").alias("k")).join(words, "h")
            .groupBy("row").agg(F.sum(F.log10(F.col("c") + 1) * F.col("k")).alias("more_sums"), F.sum("k").alias("more_known")))
    out = scored.drop("rare", "often").join(rest, "row", "left")
    even = float(np.log10(n + v + 1))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"),
        (F.col("sums") + F.coalesce("more_sums", F.lit(0.0)) - F.col("n_tokens") * F.lit(even)).alias("base_score"),
        "score", "bits_per_byte")
