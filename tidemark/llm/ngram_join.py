"""N-gram Jaccard join: a blocked sparse matrix product of documents and n-grams.

Row d of the incidence matrix A holds the distinct word n-grams of document d; A A' holds all
overlaps.  Only entries that can reach the threshold t are made:

* Columns are ordered by corpus frequency, rare first.  Sets with Jaccard >= t share at least
  t * |x| n-grams, so one of the first |x| - ceil(t |x|) + 1 columns of x.  The product over
  these columns (the rare block) meets every pair that can link.
* Two sets that link do so by their first common column, at places i and j: min(|x| - i, |y| - j)
  is at least the overlap their sizes ask for.  While columns are gathered, entries that no other
  of the column could meet so, by sizes and places, leave it.
* Then each entry has its document's parity row at hand: a bit for each hash class of n-grams,
  whether it holds an odd number of them.  Two rows differ in no more bits than their sets differ
  in n-grams, so an entry without another that differs in few enough leaves its column, too;
  documents that share a passage and nothing else are such.  What stays are near copies, and the
  columns of the same documents are one.
* A pair is made where it may have its first common column: not where both come from the same
  column before.  It is dropped if it shares fewer rare columns than two such sets must, or if one
  surely lacks more of the other's rare columns than they may differ by.
* For the pairs that are left, the other block is multiplied: whole rows, exact overlap.

Documents with the same set are one row of A.  The frequencies that order columns are those of
hash buckets: any order is exact, and 2^BITS counters keep the broadcast bounded at every size.
Components need no pair within what is already linked.  So each column first multiplies by one
centre document, which joins large groups of near copies by as many products as there are
documents; after that, only pairs between different components are made, all of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import by_value, released, text_of, written
from tidemark.llm.components import components

by_value(__name__)

#: Words of an n-gram; 100 x Jaccard similarity that links.
WORDS, PERCENT = 3, 90
#: Frequencies are kept for 2^BITS hash buckets.
BITS = 18
#: Bits of the sieve that picks texts to read again.
SIEVE_BITS = 23
#: Documents that a task compares with one centre, about.
STAR = 512
#: Sets of more n-grams also have a wide parity row, of so many 64-bit words: bits can tell apart
#: sets that differ in fewer n-grams than half of them.
WIDE_FROM, WIDE = 1500, 32
#: Times at most that columns multiply by a centre before all remaining pairs are made; they end
#: earlier once a turn links fewer than one in WORTH documents.
TURNS, WORTH = 10, 500
#: Entries of a column that a task holds to learn who is in it; a column of more is told apart by itself.
HELD = 1 << 17
#: Columns of more entries aren't gone through pair by pair for entries without a near one.
PAIRED = 1 << 12
#: Texts that a task takes out of a batch at once.
AT_ONCE = 500


def sliced(batches):
    """The batches in slices of at most AT_ONCE rows: so few texts are Python's at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, AT_ONCE):
            yield batch.slice(at, AT_ONCE)


def shingler(words: int = WORDS):
    """text -> hashes of its n-grams in order (64 bits); one for a text of fewer words."""
    import xxhash

    odd = np.uint64(0x9E3779B97F4A7C15)

    def shingles(text: str) -> np.ndarray:
        # bytes: lower() is A-Z alone, split() parts at space and \x09-\x0D
        ws = text.encode().lower().split()
        h = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, ws)), ">u8").astype(np.uint64)
        n = min(words, len(h))
        out = np.full(len(h) - n + 1 if n else 0, n, np.uint64)
        for k in range(n):
            out = (out ^ h[k:len(h) - n + 1 + k]) * odd
            out ^= out >> np.uint64(29)
        return out

    return shingles


def frequencies(docs: DataFrame, words: int = WORDS) -> np.ndarray:
    """n-grams of all documents in each hash bucket: 2^BITS numbers, whatever the input."""
    def run(batches):
        shingles, total = shingler(words), np.zeros(1 << BITS, np.int64)
        for batch in sliced(batches):
            for text in batch.column("text").to_pylist():
                np.add.at(total, shingles(text) >> np.uint64(64 - BITS), 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    rows = (docs.select(text_of().alias("text")).mapInArrow(released(run), "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow())
    out = np.zeros(1 << BITS, np.int64)
    out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return out


def parity_longs(percent: int) -> int:
    """64-bit words of a parity row.  Rows of unlike sets differ in about half their bits, sets that
    link in at most 2 (100 - percent) / (100 + percent) of their size: so many words tell sets of
    about 2000 n-grams apart, and smaller ones all the better.  Larger sets pass more often."""
    return 8 if percent >= 85 else 16


def parity(s: np.ndarray, longs: int) -> np.ndarray:
    """The parity row of a set of hashes: a bit a hash class, whether it holds an odd number."""
    bits = 64 * longs
    return np.packbits(np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).view(np.int64)


def signatures(docs: DataFrame, order: np.ndarray, words: int, percent: int) -> DataFrame:
    """``docs`` without text, with n_shingles, print (of the set), rare (its first columns), parity
    and, for large sets, wide."""
    keep, longs = [c for c in docs.columns if c != "text"], parity_longs(percent)

    def run(batches):
        import xxhash
        shingles = shingler(words)
        for batch in sliced(batches):
            n, prints, rare, odd, wide = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                s = np.unique(shingles(text))
                n.append(len(s))
                prints.append(xxhash.xxh3_128_digest(s.tobytes()))
                odd.append(parity(s, longs))
                wide.append(parity(s, WIDE) if len(s) > WIDE_FROM else None)
                first = len(s) - -(-percent * len(s) // 100) + 1 if len(s) else 0
                rare.append(s[np.argsort(order[s >> np.uint64(64 - BITS)], kind="stable")[:first]].view(np.int64))
            ends = np.cumsum([0, *map(len, rare)])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(n, pa.int64()), pa.array(prints, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *rare]))),
                 pa.array(odd, pa.list_(pa.int64())), pa.array(wide, pa.list_(pa.int64()))],
                [*keep, "n_shingles", "print", "rare", "parity", "wide"])

    return docs.mapInArrow(released(run), T.StructType(
        [docs.schema[c] for c in keep] + [T.StructField("n_shingles", T.LongType()), T.StructField("print", T.BinaryType()),
                                          T.StructField("rare", T.ArrayType(T.LongType())), T.StructField("parity", T.ArrayType(T.LongType())),
                                                          T.StructField("wide", T.ArrayType(T.LongType()))]))


def sieve(ids: DataFrame, key: str) -> np.ndarray:
    """A bitmap of 2^SIEVE_BITS bits that has the bit of every ``key`` in ``ids``.  It only saves
    work: rows that pass by chance are never joined."""
    bit = sieve_bit(F.col(key))
    words = (ids.select(F.shiftright(bit, 6).alias("w"), F.call_function("shiftleft", F.lit(1).cast("bigint"), (bit % 64).cast("int")).alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow())
    out = np.zeros(1 << SIEVE_BITS - 6, np.int64)
    out[words.column("w").to_numpy()] = words.column("b").to_numpy()
    return out.view(np.uint64)


def sieve_bit(doc_id):
    return F.pmod(F.xxhash64(F.lit("sieve"), doc_id), F.lit(1 << SIEVE_BITS))


def sifted(rows: DataFrame, wanted: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows whose ``key`` ``wanted`` may hold.  Tasks pass over the rows and keep what the sieve
    lets by, so that few are shuffled after."""
    bits = rows.sparkSession.sparkContext.broadcast(sieve(wanted, key))
    names = rows.columns

    def run(batches):
        held = bits.value
        for batch in batches:
            at = batch.column("bit").to_numpy()
            let = (held[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
            yield batch.select(names).filter(pa.array(let))

    return rows.select(sieve_bit(F.col(key)).alias("bit"), *names).mapInArrow(released(run), rows.schema)


def of_columns(batches, told):
    """``told(table, whole)`` of all entries, which come in order of ``gram``: tables end where a column
    does.  A column of over HELD entries comes in several tables of its own, not ``whole``."""
    held, parted = None, None  # the last column so far; a column too long to be held
    for batch in batches:
        table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
        if not table.num_rows:
            continue
        gram = table.column("gram").to_numpy()
        if parted is not None:
            end = int(np.searchsorted(gram, parted, "right"))
            if end:
                yield told(table.slice(0, end), False)
            table, gram = table.slice(end), gram[end:]
            parted = parted if not len(gram) else None
            held = None
            if not len(gram):
                continue
        last = int(np.searchsorted(gram, gram[-1]))
        if last:
            yield told(table.slice(0, last), True)
        table, held = table.slice(last), None
        if table.num_rows > HELD:
            parted = gram[-1]
            yield told(table, False)
        else:
            held = table.combine_chunks().to_batches()[0]
    if held is not None:
        yield told(pa.Table.from_batches([held]), True)


def who(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Of the columns that begin at ``first``, a hash of who is in each."""
    h = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    for k in (30, 27, 31):
        h = (h ^ (h >> np.uint64(k))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.add.reduceat(h ^ (h >> np.uint64(29)), first).view(np.int64)


def starts(*keys: np.ndarray) -> np.ndarray:
    """Where entries in order begin another column."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def repeated(entries: DataFrame, by_documents: bool = False, percent: int | None = None) -> DataFrame:
    """The entries (gram, id, i) of columns with more than one: one shuffle, one pass in order.
    ``by_documents``: ``gram`` tells only who is in the column, so columns of the same documents
    get the same one.  ``percent``: entries also have n, the size of their document; only those stay
    that may be the first common one with another, and columns are parted where sizes lie too far
    apart to link."""
    names = ["gram", "id", "i"]

    def told(table, whole):
        gram, ids, i = (table.column(c).to_numpy() for c in names)
        if not whole:  # some of it was sent or is to come
            return pa.RecordBatch.from_arrays([pa.array(gram), pa.array(ids), pa.array(i)], names)
        run = gram
        if percent is not None:
            n = table.column("n").to_numpy().astype(np.int64)
            far = np.append(False, 100 * n[:-1] < percent * n[1:])
            first = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]) | far)
            run = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(gram))))
            # the smaller of two sets that link has no more than this before; it comes first
            early = n - i >= least_overlap(n, n, percent)
            at = np.maximum.accumulate(np.where(early, np.arange(len(n)), -1))
            before = np.append(-1, at[:-1])
            led = (before >= first[run]) & (100 * n[before] >= percent * n)
            stay = led | (early & np.append(run[1:] == run[:-1], False))
            gram, ids, i, run = gram[stay], ids[stay], i[stay], run[stay]
            if not len(gram):
                return pa.RecordBatch.from_arrays([pa.array(gram), pa.array(ids), pa.array(i)], names)
        first = starts(gram, run)
        many = np.diff(np.append(first, len(gram)))
        name = who(ids, first) if by_documents or percent is not None else gram[first]
        more = np.repeat(many > 1, many)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(name, many)[more]), pa.array(ids[more]), pa.array(i[more])], names)

    order = ["gram"] if percent is None else ["gram", "n", "i"]
    return entries.repartition("gram").sortWithinPartitions(*order).mapInArrow(
        released(lambda batches: of_columns(batches, told)), "gram long, id long, i int")


def near(first: np.ndarray, n: np.ndarray, i: np.ndarray, odd: np.ndarray, wide: np.ndarray, has: np.ndarray, percent: int) -> np.ndarray:
    """Which entries have another in their column (columns begin at ``first``, in order of n) that they
    may link with: by sizes n, first common places i and parity rows; ``has`` says whose row is also
    ``wide``.  Entries of columns of over PAIRED are all said to."""
    many = np.diff(np.append(first, len(n)))
    end = np.repeat(first + many, many)
    found = np.repeat(many > PAIRED, many)
    a, step = np.flatnonzero(~found), 1
    while len(a):
        a = a[a + step < end[a]]
        a = a[100 * n[a] >= percent * n[a + step]]  # those after are larger still
        x, y = a, a + step
        need = least_overlap(n[x], n[y], percent)
        some = (~found[x] | ~found[y]) & (np.minimum(n[x] - i[x], n[y] - i[y]) >= need)
        x, y, differ = x[some], y[some], (n[x] + n[y] - 2 * need)[some]
        some = np.bitwise_count(odd[x] ^ odd[y]).sum(1, dtype=np.int64) <= differ
        x, y, differ = x[some], y[some], differ[some]
        both = np.flatnonzero(has[x] & has[y])
        some = np.ones(len(x), bool)
        some[both] = np.bitwise_count(wide[x[both]] ^ wide[y[both]]).sum(1, dtype=np.int64) <= differ[both]
        found[x[some]] = found[y[some]] = True
        step += 1
    return found


def near_entries(entries: DataFrame, matrix: DataFrame, percent: int) -> DataFrame:
    """Of ``entries`` (gram, id, m, i0, i), those with another in their column that is ``near``;
    columns of the same documents are one again, with the sum of m, the first i0 and the last i."""
    longs, names = parity_longs(percent), ["gram", "id", "m", "i0", "i"]

    def told(table, whole):
        gram, ids = table.column("gram").to_numpy(), table.column("id").to_numpy()
        out = table.select(names).combine_chunks()
        if whole:
            n, i = table.column("n").to_numpy(), table.column("i0").to_numpy().astype(np.int64)
            odd = np.stack([table.column(f"p{k}").to_numpy() for k in range(longs)], 1).view(np.uint64)
            rows = table.column("wide").combine_chunks()
            has = rows.is_valid().to_numpy(zero_copy_only=False)
            wide = np.zeros((len(has), WIDE if has.any() else 0), np.uint64)
            if has.any():
                wide[has] = rows.drop_null().flatten().to_numpy().reshape(-1, WIDE).view(np.uint64)
            stay = near(starts(gram), n, i, odd, wide, has, percent)
            out, gram, ids = out.filter(pa.array(stay)), gram[stay], ids[stay]
            if len(gram):
                first = starts(gram)
                gram = np.repeat(who(ids, first), np.diff(np.append(first, len(gram))))
        return pa.RecordBatch.from_arrays(
            [pa.array(gram), *(out.column(c).combine_chunks() for c in names[1:])], names)

    sized = entries.join(narrow(matrix, percent), "id")
    left = sized.repartition("gram").sortWithinPartitions("gram", "n").mapInArrow(
        released(lambda batches: of_columns(batches, told)), "gram long, id long, m long, i0 int, i int")
    return left.groupBy("gram", "id").agg(F.sum("m").alias("m"), F.min("i0").alias("i0"), F.max("i").alias("i"))


def overlapping(pairs: DataFrame, matrix: DataFrame, keep) -> DataFrame:
    """Of ``pairs`` (a, b), those whose rare columns overlap enough, as ``keep`` says."""
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
    rows = sifted(matrix.select("id", "n", "rare"), ids, "id")
    x, y = (rows.select(F.col("id").alias(k), F.col("rare").alias(c), F.col("n").alias(f"n{c}")) for k, c in (("a", "x"), ("b", "y")))

    def run(batches):
        for batch in batches:
            cols = [batch.column(c) for c in ("x", "y", "nx", "ny")]
            ok = [keep(u.values.to_numpy(), v.values.to_numpy(), m.as_py(), n.as_py()) for u, v, m, n in zip(*cols)]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y", "nx", "ny").mapInArrow(released(run), "a long, b long")


def common(x: np.ndarray, y: np.ndarray) -> int:
    """Numbers that two sorted sets share."""
    if len(x) > len(y):
        x, y = y, x
    return int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum()) if len(x) else 0


def least_overlap(m, n, percent: int):
    """Overlap that Jaccard >= percent asks of sets of m and n."""
    return -(-percent * (m + n) // (100 + percent))


def least_rare(m: int, n: int, percent: int) -> int:
    """First columns that such sets share at least: the kth common column of x stands at most
    at k + |x| less the overlap."""
    need = least_overlap(m, n, percent)
    first = lambda k: k + percent * -k // 100 + 1  # noqa: E731  k less the ceiling of percent * k
    return max(1, min(first(m) - m + need, first(n) - n + need))


def surely_missing(x: np.ndarray, y: np.ndarray, order: np.ndarray) -> tuple[int, int]:
    """Of the first columns of two rows, how many both have, and how many of x the other surely
    lacks: those not among the first of y though they come before the last of these."""
    low = np.sort(y)
    has = low[np.minimum(np.searchsorted(low, x), len(low) - 1)] == x
    f, last = order[x >> np.uint64(64 - BITS)], order[y[-1] >> np.uint64(64 - BITS)]
    before = (f < last) | ((f == last) & (x < y[-1]))
    return int(has.sum()), int((before & ~has).sum())


def verified(pairs: DataFrame, matrix: DataFrame, docs: DataFrame, words: int, percent: int, order: np.ndarray) -> DataFrame:
    """Of ``pairs``, those that link: first by their rare columns, then by whole rows."""
    def rare(x, y, m, n):
        x, y = x.view(np.uint64), y.view(np.uint64)
        both, x_only = surely_missing(x, y, order)
        need = least_overlap(m, n, percent)
        return both >= least_rare(m, n, percent) and x_only <= m - need and surely_missing(y, x, order)[1] <= n - need

    def whole(x, y, m, n):
        both = common(x, y)
        return 100 * both >= percent * (m + n - both)

    left = written(overlapping(written(pairs, "grams-pairs"), matrix, rare), "grams-left")
    # the texts of a star meet in its centre's task; large stars are parted, the centre goes along
    stars = left.groupBy("b").agg(F.ceil(F.count("*") / STAR).cast("int").alias("parts"))
    mine = F.pmod(F.xxhash64("a"), F.col("parts")).cast("int")
    asked = left.join(stars, "b").select(F.col("a").alias("id"), F.col("b").alias("star"), mine.alias("part"), F.lit(1).alias("ray"))
    asked = asked.unionByName(stars.select(F.col("b").alias("id"), F.col("b").alias("star"), F.explode(
        F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("ray")))
    asked = written(asked.join(matrix.select("id", "print", "doc_id", "n"), "id"), "grams-asked")

    def run(batches):
        import xxhash
        shingles = shingler(words)
        where, centre, seen = None, None, None
        for batch in batches:
            a, b = [], []
            for r in batch.to_pylist():
                if (r["star"], r["part"]) != where:
                    where, centre, seen = (r["star"], r["part"]), None, None
                if r["ray"] == 1 and (centre is None or r["id"] == seen):
                    continue
                s = np.unique(shingles(r["text"]))
                if xxhash.xxh3_128_digest(s.tobytes()) != r["print"]:
                    continue  # another text under the same doc_id
                if r["ray"] == 0:
                    centre = s
                    continue
                seen = r["id"]
                if whole(s, centre, len(s), len(centre)):
                    a.append(r["id"])
                    b.append(r["star"])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    texts = sifted(docs.select("doc_id", "text"), asked).withColumnRenamed("doc_id", "of")
    rows = asked.join(texts, F.col("doc_id").eqNullSafe(F.col("of"))).select("star", "part", "ray", "id", "print", "text")
    met = rows.repartition("star", "part").sortWithinPartitions("star", "part", "ray", "id")
    return written(met.mapInArrow(released(run), "a long, b long"), "grams-links")


def joined(parts: DataFrame | None, links: DataFrame) -> DataFrame:
    """The components ``parts`` (v, root; None: none yet) after ``links`` (a, b) more.  Links of the
    same two components are one, so that a round of components has few, however many copies link."""
    if parts is None:
        return components(links)
    for c in ("a", "b"):
        to = parts.select(F.col("v").alias(c), F.col("root").alias(f"r{c}"))
        links = links.join(to, c, "left").withColumn(f"r{c}", F.coalesce(f"r{c}", c))
    up = components(links.filter("ra != rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct())
    moved = parts.join(up.select(F.col("v").alias("root"), F.col("root").alias("top")), "root", "left")
    return written(moved.select("v", F.coalesce("top", "root").alias("root"))
                   .unionByName(up.join(parts.select("v"), "v", "left_anti")), "grams-parts")


def rooted(rare: DataFrame, parts: DataFrame) -> DataFrame:
    """Entries with the component of their document, of columns that meet more than one."""
    own = rare.join(parts.withColumnRenamed("v", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    split = own.groupBy("gram").agg(F.min("root").alias("r0"), F.max("root").alias("r1"))
    return own.join(split.filter("r0 != r1").select("gram"), "gram")


def narrow(matrix: DataFrame, percent: int) -> DataFrame:
    """What ``alike`` asks of a row of the matrix."""
    return matrix.select("id", "n", "wide", *[F.col("parity")[k].alias(f"p{k}") for k in range(parity_longs(percent))])


def alike(percent: int) -> Column:
    """Whether two rows (columns ending in _x and _y) may link by their sizes and parity rows."""
    both = F.col("n_x") + F.col("n_y")
    differ = both - 2 * F.ceil(F.lit(percent) * both / (100 + percent))
    apart = sum((F.bit_count(F.col(f"p{k}_x").bitwiseXOR(F.col(f"p{k}_y"))) for k in range(parity_longs(percent))), F.lit(0))
    apart_wide = sum((F.bit_count(F.col("wide_x")[k].bitwiseXOR(F.col("wide_y")[k])) for k in range(WIDE)), F.lit(0))
    return ((100 * F.least("n_x", "n_y") >= percent * F.greatest("n_x", "n_y")) & (apart <= differ)
            & F.coalesce(apart_wide <= differ, F.lit(True)))


def stars(own: DataFrame, matrix: DataFrame, turn: int, percent: int) -> DataFrame:
    """Pairs (a, b) of a document and the centre of its columns, if in another component and alike:
    for each document the centre it shares most columns with."""
    order = F.xxhash64(F.lit(turn), "id")
    centre = own.groupBy("gram").agg(F.min(order).alias("o"))
    centre = (own.withColumn("o", order).join(centre, ["gram", "o"]).groupBy("gram")
              .agg(F.min("id").alias("centre"), F.min("root").alias("hub")))
    pairs = (own.join(centre, "gram").filter("root != hub").groupBy("id", "centre").agg(F.sum("m").alias("common"))
             .groupBy("id").agg(F.max_by("centre", "common").alias("b")).select(F.col("id").alias("a"), "b"))
    x, y = (narrow(matrix, percent).toDF(k, *[f"{c}_{z}" for c in narrow(matrix, percent).columns[1:]]) for k, z in (("a", "x"), ("b", "y")))
    return pairs.join(x, "a").join(y, "b").filter(alike(percent)).select("a", "b")


def jaccard_join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT,
                 carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; of other columns those in ``carry`` stay): doc_id,
    n_shingles, component_id, the smallest doc_id reachable by links, and group, which rows of one
    component share (null without n-grams).

    Null and empty texts, and those of white space: no n-grams, no links, a component of their own.
    Texts of fewer words: their whole sequence is the one n-gram.  Repeated texts link; rows with
    one doc_id and other texts are documents of their own.  A null doc_id is never the smallest.
    Empty table: empty result."""
    docs = docs.select("doc_id", *carry, text_of().alias("text"))
    order = frequencies(docs, words)
    signs = written(signatures(docs, order, words, percent), "grams-signs")
    # documents of one set are one row of the matrix
    matrix = (signs.filter("n_shingles > 0").groupBy("print")
              .agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("rare").alias("rare"),
                   F.first("parity").alias("parity"), F.first("wide").alias("wide")))
    matrix = written(matrix.withColumn("id", F.monotonically_increasing_id()), "grams-matrix")
    entries = matrix.select("id", F.col("n").cast("int").alias("n"), F.posexplode("rare").alias("i", "gram"))
    # m columns of the same documents are one; i0 and i are the places of the first and the last
    rare = written(repeated(entries.select("gram", "id", "i", "n"), percent=percent).groupBy("gram", "id")
                   .agg(F.count("*").alias("m"), F.min("i").alias("i0"), F.max("i").alias("i")), "grams-rare")
    rare = written(near_entries(rare, matrix, percent), "grams-near")

    parts, own, rows = None, rare.withColumn("root", F.col("id")), matrix.count()
    for turn in range(TURNS):
        more = verified(stars(own, matrix, turn, percent), matrix, docs, words, percent, order)
        parts = joined(parts, more)
        # components only grow, so a column that meets one stays out
        own = written(rooted(own.select("gram", "id", "m", "i0", "i"), parts), "grams-split")
        if more.count() * WORTH < rows:
            break

    # what is left: every pair of different components, made where its first common column may be:
    # not where both come from the same one before.  Documents outside a column's largest component
    # meet all others in it.
    sizes = own.groupBy("gram", "root").agg(F.count("*").alias("k"))
    hub = sizes.groupBy("gram").agg(F.max_by("root", F.col("k")).alias("hub"))
    cols = [c for c in narrow(matrix, percent).columns if c != "id"]
    before = F.lag("gram").over(Window.partitionBy("id").orderBy("i0"))
    sized = own.withColumn("before", before).join(narrow(matrix, percent), "id")
    cols = ["id", "i0", "i", "root", "before", *cols]
    x = sized.join(hub, "gram").filter("root != hub").select("gram", "hub", *[F.col(c).alias(f"{c}_x") for c in cols])
    y = sized.select("gram", *[F.col(c).alias(f"{c}_y") for c in cols])
    # at common columns from places i0 to i, the overlap is at most what the shorter rest allows from
    # i0 on, and min(i, j) before the last, 1, and what the rest allows after it
    most = F.least(F.col("n_x") - F.col("i0_x"), F.col("n_y") - F.col("i0_y"),
                   F.least("i_x", "i_y") + 1 + F.least(F.col("n_x") - F.col("i_x") - 1, F.col("n_y") - F.col("i_y") - 1))
    met = (x.join(y, "gram").filter(
        (F.col("root_x") != F.col("root_y")) & ((F.col("root_y") == F.col("hub")) | (F.col("id_x") < F.col("id_y")))
        & F.coalesce(F.col("before_x") != F.col("before_y"), F.lit(True))
        & (most * (100 + percent) >= percent * (F.col("n_x") + F.col("n_y"))) & alike(percent))
        .select(F.least("id_x", "id_y").alias("a"), F.greatest("id_x", "id_y").alias("b")).distinct())
    parts = joined(parts, verified(met, matrix, docs, words, percent, order))
    least = (matrix.select("id", "print", "doc_id").join(parts.withColumnRenamed("v", "id"), "id", "left")
             .withColumn("root", F.coalesce("root", "id")))
    lowest = least.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = least.join(lowest, "root").select(F.col("print").alias("p"), "component_id", F.col("root").alias("group"))
    out = signs.select("doc_id", *carry, "n_shingles", "print").join(named, F.col("print") == F.col("p"), "left")
    return out.select("doc_id", *carry, "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id"))
                      .otherwise(F.col("doc_id")).alias("component_id"), "group")
