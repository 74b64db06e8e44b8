"""Near-duplicate documents by the Jaccard similarity of their word n-grams, exactly.

Documents of equal n-gram sets form a class, and classes are compared.

Tiles. Sizes fall into bands so wide that a class can only be similar to classes
of its own band and of the next. In the tile of a band the hash space is cut
into parts, one more than two similar sets can differ in elements, so at least
one part holds the same elements in both; the hash of each part's elements is a
key, and similar classes share a key. A few more parts allow for parts that are
empty in both; a class with more empty parts than that adds keys under further
seeds, and under the last seed empty parts give keys as well. So no pair is lost.

Bounds. Each class that shares a key has a bitmap of hashed elements, which grows
with its set: at least ``BITS_EACH`` bits an element. The bits that one bitmap
has beyond the other bound the overlap from above. Under a key, bitmaps are
compared many at once, folded to one or two bits an element, and the pairs left at
the width of the smaller one; those that may still be similar are settled by
intersecting the sorted sets. A phrase that many documents hold makes keys whose
classes grow with the corpus and their pairs with its square, so a pair that
shares little must be cheap. Bitmaps are stored and shuffled entropy-coded, as few
of their bits are set: a class goes with its bitmap to every key that is compared.

Order of work. Every class is compared with the class that is the least under
most of its keys, and components are formed. Keys that hold several components
then offer, for each class, a near partner of another component; and in a last pass
those keys that offered any give every pair of different components that the
bitmaps admit. After that pass no link between two components can be left. Of keys
that hold the same classes, told by two hashes, both passes look at one. Keys with
many classes are cut into blocks, and each pair of blocks is a group of its own, so
no task holds a whole large key.

Cases: a NULL or empty text has an empty set and is alone. Fewer words than an
n-gram make one n-gram. Equal texts have equal results. A row with a NULL id
joins its class but gives it no name; a class without an id has none. Empty
tables give no rows. Texts are read whole. Only the named columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from cdclake.llm.common import release, spread, stored, table
from cdclake.llm.components import components
from cdclake.llm.hashing import mix, shingle_sets, slices

BITS = 1024
BITS_EACH = 8
SEEDS = 6
#: Classes of one key compared in one group, at most twice as many.
BLOCK = 2048
#: More than any set has elements.
SIZES = 1 << 40
#: Pairs of rows looked at together, words of narrow bitmaps compared at once (they stay in a core's cache), and bytes of whole bitmaps held decoded.
PAIRS, WORDS, HELD = 1 << 14, 1 << 14, 1 << 25


def bands(num: int, den: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The least size of each band, the parts of its tile, and how many of them may be empty."""
    lows = [1]
    while lows[-1] < 1 << 40:
        lows.append(lows[-1] * den // num + 1)
    low = np.array(lows, np.int64)
    high = low * den // num
    parts = 2 * high * (den - num) // (den + num) + 1
    empty = parts * np.exp(-low / parts)
    allowed = np.where(empty > 0.05, np.floor(empty + 2 * np.sqrt(empty)), 0).astype(np.int64)
    return low, parts + allowed, allowed


def tile_keys(found: np.ndarray, of: np.ndarray, sizes: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys of all sets and the set of each key; ``found`` are the elements and ``of`` the number of their set."""
    low, parts, allowed = bands(num, den)
    band = np.searchsorted(low, np.maximum(sizes, 1), "right") - 1
    keys, owners = [], []
    for tile in (band, band + 1):
        m, spare = parts[tile], allowed[tile]
        open_sets = sizes > 0
        for seed in range(SEEDS):
            mine = open_sets[of]
            x, who = mix(found[mine] + np.uint64(2 * seed + 1)), of[mine]
            count = np.where(open_sets, m, 0)
            start = np.cumsum(count) - count
            at = start[who] + ((x >> np.uint64(32)) * m[who].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
            sums = np.zeros(int(count.sum()), np.uint64)
            np.add.at(sums, at, mix(x + np.uint64(977)))
            filled = np.bincount(at, minlength=len(sums)) > 0
            owner = np.repeat(np.arange(len(sizes)), count)
            empty = np.bincount(owner[~filled], minlength=len(sizes))
            use = filled if seed < SEEDS - 1 else np.ones(len(sums), bool)
            part = np.arange(len(sums)) - start[owner]
            label = (tile[owner] * SEEDS + seed).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + part.astype(np.uint64)
            keys.append(mix(sums[use] + mix(label[use])))
            owners.append(owner[use])
            open_sets = open_sets & (empty > spare)
            if not open_sets.any():
                break
    return np.concatenate(keys).view(np.int64), np.concatenate(owners)


def _set_sums(found: np.ndarray, of: np.ndarray, count: int) -> np.ndarray:
    """Two sums over the elements of each set, which together tell sets apart."""
    sums = np.zeros((2, count), np.uint64)
    np.add.at(sums[0], of, found)
    np.add.at(sums[1], of, mix(found + np.uint64(5)))
    return sums.view(np.int64)


def document_sets(docs: DataFrame, size: int) -> DataFrame:
    """Per row: ``doc_id``, ``n`` and the two sums that identify the set."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in slices(batches):
            found, of = shingle_sets(list(rows["text"]), size)
            low, high = _set_sums(found, of, len(rows))
            yield pd.DataFrame({
                "doc_id": rows["doc_id"].array, "n": np.bincount(of, minlength=len(rows)), "lo": low, "hi": high,
            })

    return spread(docs.select("doc_id", "text")).mapInPandas(run, "doc_id bigint, n bigint, lo bigint, hi bigint")


def document_keys(docs: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """``key`` and ``rep``, a document, of every set; sets that are equal within a batch have their keys once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in slices(batches):
            found, of = shingle_sets(list(rows["text"]), size)
            sums = _set_sums(found, of, len(rows))
            first = np.unique(sums, axis=1, return_index=True)[1]
            kept = np.zeros(len(rows), bool)
            kept[first] = True
            found, of = found[kept[of]], of[kept[of]]
            key, owner = tile_keys(found, of, np.bincount(of, minlength=len(rows)), num, den)
            yield pd.DataFrame({"key": key, "rep": rows["doc_id"].to_numpy(np.int64)[owner]})

    known = docs.where("doc_id is not null").select("doc_id", "text")
    return spread(known).mapInPandas(run, "key bigint, rep bigint")


def _shared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of rows sorted by key, those whose key has several."""
    key = held = None
    for batch in batches:
        k = batch["key"].to_numpy()
        if not len(k):
            continue
        before = np.concatenate([[key is not None and k[0] == key], k[1:] == k[:-1]])
        several = before | np.concatenate([before[1:], [False]])
        if held is not None and before[0]:
            yield held
        yield batch[several]
        # The last row waits for the next batch unless its key has come before.
        held, key = (None if several[-1] else batch[-1:]), k[-1]


def _admits(na, nb, beyond_a, beyond_b, num: int, den: int) -> np.ndarray:
    """Whether sets with so many bits beyond the other's bitmap can be similar."""
    most = np.minimum(na - beyond_a, nb - beyond_b)
    return den * most >= num * (na + nb - most)


def bitmap(found: np.ndarray) -> bytes:
    """The elements' low bits as a bitmap of a power of two of bits, coded for ``_bits``."""
    width = max(BITS, 1 << (BITS_EACH * len(found) - 1).bit_length())
    bits = np.zeros(width, bool)
    bits[(found & np.uint64(width - 1)).astype(np.int64)] = True
    # Bits of hashes hold no repeats to look for, so bytes are coded by their frequency alone.
    coder = zlib.compressobj(1, zlib.DEFLATED, -15, 8, zlib.Z_HUFFMAN_ONLY)
    return coder.compress(np.packbits(bits, bitorder="little").tobytes()) + coder.flush()


def _bits(coded: bytes) -> np.ndarray:
    """A bitmap as 64-bit words."""
    return np.frombuffer(zlib.decompress(coded, -15), np.uint64)


def _folded(bits: np.ndarray, words: int) -> np.ndarray:
    """A bitmap of so many 64-bit words, of a wider one: its parts laid over each other."""
    return np.bitwise_or.reduce(bits.reshape(-1, words), axis=0) if len(bits) > words else bits


def _beyond(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """How many bits either bitmap has beyond the other, at the width of the narrower."""
    words = min(len(a), len(b))
    a, b = _folded(a, words), _folded(b, words)
    return int(np.bitwise_count(a & ~b).sum()), int(np.bitwise_count(b & ~a).sum())


def verified(pairs: DataFrame, reps: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs ``a``, ``b`` that are similar: first by size and bitmap, then by the sets."""

    def bound(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                over = np.array([_beyond(_bits(x), _bits(y)) for x, y in zip(batch["ba"], batch["bb"])], np.int64)
                yield batch.loc[_admits(batch["na"].to_numpy(), batch["nb"].to_numpy(), *over.T, num, den), ["a", "b"]]

    def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            both = np.array([
                len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(batch["sa"], batch["sb"])
            ], np.int64)
            union = batch["sa"].map(len).to_numpy(np.int64) + batch["sb"].map(len).to_numpy(np.int64) - both
            yield batch.loc[den * both >= num * union, ["a", "b"]]

    side = lambda end: reps.select(
        F.col("rep").alias(end), F.col("n").alias(f"n{end}"), F.col("bitmap").alias(f"b{end}"))
    near = pairs.join(side("a"), "a").join(side("b"), "b").where(
        f"{den} * least(na, nb) >= {num} * greatest(na, nb)"
    )
    likely = stored(near.select("a", "b", "na", "nb", "ba", "bb").mapInPandas(bound, "a bigint, b bigint"), "likely")
    elements = lambda end: sets.select(F.col("rep").alias(end), F.col("elements").alias(f"s{end}"))
    full = likely.distinct().join(elements("a"), "a").join(elements("b"), "b").select("a", "b", "sa", "sb")
    return stored(full.mapInPandas(exact, "a bigint, b bigint"), "similar")


def near_rows(
    group: np.ndarray, component: np.ndarray, n: np.ndarray, left: np.ndarray, right: np.ndarray, coded: np.ndarray, num: int, den: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of rows of one group and different components, a left and a right one, that size and narrow bitmap admit.

    With them goes the number of bits by which the narrow bitmaps differ. Rows are
    sorted by group and size. A narrow bitmap has a bit an element at least: sets
    of any size that share little differ in more of those bits than similar sets can.
    """
    words = np.array([max(BITS, 1 << (int(x) - 1).bit_length()) // 64 for x in n])
    narrow = [_folded(_bits(x), k) for x, k in zip(coded, words)]
    # The partners of a row are the rows after it, up to the greatest size that can be similar.
    sizes = group * SIZES + n
    end = np.searchsorted(sizes, group * SIZES + np.minimum(den * n // num, SIZES - 1), "right")
    count = end - np.arange(len(n)) - 1
    for width in np.unique(words[count > 0]):
        mine = np.flatnonzero((words == width) & (count > 0))
        steps = np.zeros(len(n) + 1, np.int64)
        np.add.at(steps, mine, 1)
        np.add.at(steps, end[mine], -1)
        used = np.cumsum(steps[:-1]) > 0
        bits = np.array([_folded(narrow[k], width) for k in np.flatnonzero(used)])
        place, ones = np.cumsum(used) - 1, np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        total = np.cumsum(count[mine])
        for start in range(0, int(total[-1]), PAIRS):
            pair = np.arange(start, min(start + PAIRS, total[-1]))
            of = np.searchsorted(total, pair, "right")
            i = mine[of]
            j = i + 1 + pair - (total[of] - count[i])
            ok = (component[i] != component[j]) & (left[i] & right[j] | left[j] & right[i])
            i, j = i[ok], j[ok]
            x, y = place[i], place[j]
            apart, few = np.zeros(len(i), np.int64), max(1, WORDS // width)
            for k in range(0, len(i), few):
                over = bits.take(x[k : k + few], 0)
                over ^= bits.take(y[k : k + few], 0)
                apart[k : k + few] = np.bitwise_count(over).sum(axis=1, dtype=np.int64)
            more = ones[x] - ones[y]
            ok = _admits(n[i], n[j], (apart + more) // 2, (apart - more) // 2, num, den)
            yield i[ok], j[ok], apart[ok]


def near_pairs(rows: pd.DataFrame, group: np.ndarray, num: int, den: int, best: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the pairs of ``near_rows`` those that the whole bitmaps admit, and the bits by which they differ.

    With ``best``, each row that has any is first in one pair, whose other row is near and need not be the nearest.
    """
    order = np.lexsort((rows["n"].to_numpy(), group))
    component, n, left, right, coded = (rows[c].to_numpy()[order] for c in ("component", "n", "left", "right", "bitmap"))
    held: dict[int, np.ndarray] = {}
    room = HELD

    def whole(i: int) -> np.ndarray:
        nonlocal room
        if i not in held:
            if room < 0:
                held.clear()
                room = HELD
            held[i] = _bits(coded[i])
            room -= held[i].nbytes
        return held[i]

    def look(i: int, j: int) -> int | None:
        over = _beyond(whole(i), whole(j))
        return sum(over) if _admits(n[i], n[j], *over, num, den) else None

    found: list[tuple[int, int, int]] = []
    nearest, partner, whole_apart = np.full(len(n), SIZES), np.full(len(n), -1), np.zeros(len(n), np.int64)
    for i, j, apart in near_rows(group[order], component, n, left, right, coded, num, den):
        if best:
            # Nearest first; one that the whole bitmaps admit is enough, so copies of one text cost a look each.
            x, y, apart = np.concatenate([i, j]), np.concatenate([j, i]), np.concatenate([apart, apart])
            nearer = np.flatnonzero(apart < nearest[x])
            nearer = nearer[np.lexsort((apart[nearer], x[nearer]))]
            done = -1
            for a, b, narrow_apart in zip(x[nearer].tolist(), y[nearer].tolist(), apart[nearer].tolist()):
                if a != done and (bits_apart := look(a, b)) is not None:
                    nearest[a], partner[a], whole_apart[a], done = narrow_apart, b, bits_apart, a
        else:
            found += [(a, b, k) for a, b in zip(i.tolist(), j.tolist()) if (k := look(a, b)) is not None]
    if best:
        i = np.flatnonzero(partner >= 0)
        j, apart = partner[i], whole_apart[i]
    else:
        i, j, apart = np.array(found, np.int64).reshape(-1, 3).T
    return order[i], order[j], apart


def cross_pairs(rows: DataFrame, num: int, den: int, best: bool) -> DataFrame:
    """Pairs ``x``, ``y`` of classes of different components under one key that size and bitmap admit.

    ``rows`` have ``key``, ``rep``, ``component``, ``n``, ``bitmap`` and ``blocks``.
    With ``best``, each class has one partner under a key, and with it go ``key`` and
    ``apart``, the bits by which they differ.
    """
    names = ["key", "x", "y"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def flush(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
            if len(frame):
                new = np.any([np.diff(frame[c].to_numpy(), prepend=frame[c].iloc[0]) != 0 for c in names], axis=0)
                i, j, apart = near_pairs(frame, np.cumsum(new), num, den, best)
                x, y = frame["rep"].to_numpy()[i], frame["rep"].to_numpy()[j]
                if best:
                    yield pd.DataFrame({"x": x, "y": y, "key": frame["key"].to_numpy()[i], "apart": apart})
                else:
                    yield pd.DataFrame({"x": np.maximum(x, y), "y": np.minimum(x, y)}).drop_duplicates()

        for batch in batches:
            if not len(batch):
                continue
            last = (batch[names] == batch[names].iloc[-1]).all(axis=1).to_numpy()
            if held and last.all() and (held[-1][names].iloc[-1] == batch[names].iloc[0]).all():
                held.append(batch)
                continue
            yield from flush(pd.concat([*held, batch[~last]]))
            held = [batch[last]]
        if held:
            yield from flush(pd.concat(held))

    mine = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    tiled = (
        rows.withColumn("own", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))))
        .select(
            "key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "rep", "component", "n", "bitmap",
            (F.col("own") <= F.col("other")).alias("left"), (F.col("own") >= F.col("other")).alias("right"),
        )
    )
    schema = "x bigint, y bigint" + ", key bigint, apart bigint" * best
    return tiled.repartition(*names).sortWithinPartitions(*names).mapInPandas(run, schema)


def jaccard_components(docs: DataFrame, size: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row; similar is ``den * overlap >= num * union``."""
    spark = docs.sparkSession
    found = stored(document_sets(docs, size), "shingle-sets")
    named = found.where("n > 0 and doc_id is not null")
    reps = stored(
        named.groupBy("n", "lo", "hi").agg(F.min("doc_id").alias("rep")), "classes"
    )
    # Most keys occur once and go no further than this shuffle.
    met = stored(
        document_keys(docs, size, num, den).repartition("key").sortWithinPartitions("key")
        .mapInPandas(_shared, "key bigint, rep bigint"), "shared-keys"
    )
    release(spark)
    class_of = named.select("n", "lo", "hi", F.col("doc_id").alias("member")).join(reps, ["n", "lo", "hi"])
    by_class = met.join(class_of.select("member", F.col("rep").alias("class")).distinct(), F.col("rep") == F.col("member")).select(
        "key", F.col("class").alias("rep")).distinct()
    by_class = stored(by_class, "class-keys")
    leads = stored(by_class.groupBy("key").agg(
        F.min("rep").alias("lead"), F.count("*").alias("n"),
        *[F.bit_xor(F.xxhash64(F.lit(i), "rep")).alias(f"sum{i}") for i in (0, 1)],
    ).where("n > 1"), "key-classes")
    shared = stored(by_class.join(leads.select("key", "lead"), "key"), "shared-classes")
    # Near copies share most of their parts: of keys that hold the same classes one is enough to compare them under.
    telling = leads.groupBy("n", "lead", "sum0", "sum1").agg(F.min("key").alias("key")).select("key")

    def elements(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in slices(batches):
            x, of = shingle_sets(list(rows["text"]), size)
            sets = np.split(x, np.searchsorted(of, np.arange(1, len(rows))))
            yield pd.DataFrame({
                "rep": rows["doc_id"].array, "n": [len(x) for x in sets], "bitmap": [bitmap(x) for x in sets],
                "elements": [x.view(np.int64) for x in sets],
            })

    involved = shared.select(F.col("rep").alias("doc_id")).distinct()
    sets = stored(
        docs.select("doc_id", "text").join(involved, "doc_id", "left_semi")
        .mapInPandas(elements, "rep bigint, n bigint, bitmap binary, elements array<bigint>"), "elements"
    )
    release(spark)
    # Rows that occur often count once, so that a block has no more rows than classes.
    small = stored(sets.select("rep", "n", "bitmap").distinct(), "bitmaps")
    compared = stored(shared.select("key", "rep").join(telling, "key", "left_semi"), "compared-classes")
    # Each class and the least class of most of its keys. A pair to be settled carries a whole set through a
    # shuffle, so each step leaves as few as it can to the next.
    star = shared.where("rep <> lead").groupBy("rep", "lead").agg(F.count("*").alias("n")).groupBy("rep").agg(
        F.max_by("lead", F.struct("n", "lead")).alias("lead")
    )
    links = verified(star.select(F.col("rep").alias("a"), F.col("lead").alias("b")), small, sets, num, den)
    for best in (True, False):
        named = components(links)
        with_component = compared.join(named.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
            "component", F.coalesce("component", "rep")
        )
        mixed = with_component.groupBy("key").agg(
            F.min("component").alias("p"), F.max("component").alias("q"), F.count("*").alias("rows")
        ).where("p <> q").select("key", F.ceil(F.col("rows") / BLOCK).alias("blocks"))
        rows = with_component.join(mixed, "key").join(small, "rep")
        pairs = cross_pairs(rows, num, den, best)
        if best:
            pairs = stored(pairs, "key-partners")
            # A key under which no pair is admitted now has none later: components only grow.
            compared = compared.join(pairs.select("key").distinct(), "key", "left_semi")
            pairs = pairs.groupBy("x").agg(F.min_by("y", F.struct("apart", "y")).alias("y"))
        pairs = stored(
            pairs.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "cross-pairs"
        )
        links = links.union(verified(pairs, small, sets, num, den))
        release(spark)
    named = components(links)
    classes = reps.select("n", "lo", "hi", "rep").join(named.withColumnRenamed("node", "rep"), "rep", "left").select(
        "n", "lo", "hi", F.coalesce("component", "rep").alias("__component")
    )
    return found.select("doc_id", "n", "lo", "hi").join(classes, ["n", "lo", "hi"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("__component")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
