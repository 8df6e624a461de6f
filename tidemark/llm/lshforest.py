"""Near-duplicate groups by an LSH forest over MinHash signatures.

Several trees each put the documents in the sorted order of their own sequence of MinHash values. In that
order the neighbours of a document are those with the longest common prefix, so looking a few places ahead
takes a deep prefix where many documents crowd and a shallow one where few are: the depth adapts to the
region. Candidates come from trees only; every link is then confirmed on the full shingle sets.

A document that already is in one group with a neighbour is no candidate again, so a group of thousands of near
copies shrinks to one in two cheap rounds, which confirm a document's likeliest neighbours only. These rounds settle
nothing else: then every bucket (the documents that share the first half of a tree's key) that still holds two groups
is gone through whole. Its members outside its largest group ask all its members, and each pair of different groups
whose signatures are near enough and whose rarest shingles agree enough is confirmed, the likeliest first, until no
candidate joins two groups. A bucket is cut into units that are bounded in documents and in bytes, so none is one task's work
and very long texts meet a few at a time.

The rarest shingles are an exact bound, so they lose no link. All shingles have one order, by how often their counter was
met in the documents of such buckets and then by hash; a document brings the first of its own. Of these, those that come
before the other's last one and are not among the other's are certainly not shared; a pair with more of them on one side
than a near pair can have is refuted.

Defined results: a null or blank text has an empty set and is linked with nothing; equal sets are one class
whatever their texts; rows that repeat an id are one document (one row each in the result, linked by any of
their texts); a null id cannot be named, so its row has component null and kept false; an empty table gives an
empty result; columns other than the id and the text are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components, joined_components
from tidemark.llm.files import shared_dir, written
from tidemark.llm.textscan import SPACES, WordScanner, binary_array, column_bytes, mix, ragged_array, shingles, slices

HASHES = 256
#: Of these the first half makes the trees' keys.
TREE_HASHES = 128
TREES = 24
#: Values of a tree's full key; two documents are neighbours if they share at least the first half.
DEPTH = 8
#: Bytes of the sketch that a tree row carries.
SKETCH = 64
#: Candidates of a document that one of the two first rounds confirms, and that one tree gives to them.
LIKELIEST, NEAREST = 4, 2
#: Documents of a bucket on each side of a unit, about, and their bytes, about: a document has FIXED, and PER_SHINGLE for each shingle.
UNIT, UNIT_BYTES = 2048, 8 << 20
FIXED, PER_SHINGLE = 640, 2
#: A document's candidates are dealt to so many parts; of each part the likeliest AT_ONCE are confirmed, then STEP times as many, until none is left.
PARTS, AT_ONCE, STEP = 8, 1, 16
#: Bits of a shingle that say which counter tells how rare it is: a byte for each of the counters goes to every task.
SLOT_BITS = 18
#: An id's place in the filter that spares texts without candidates a shuffle: a broadcast of at most so many ints.
PLACES = 1 << 18


def _factors() -> np.ndarray:
    return mix(np.arange(1000, 1000 + HASHES, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _orders() -> np.ndarray:
    """For each tree, the hash functions that make its key."""
    rng = np.random.default_rng(20240)
    picks = [rng.permutation(TREE_HASHES) for _ in range(-(-TREES * DEPTH // TREE_HASHES))]
    return np.concatenate(picks)[: TREES * DEPTH].reshape(TREES, DEPTH)


def _sets(scanner: WordScanner, data: np.ndarray, at: np.ndarray, width: int):
    starts, ends, first = scanner.split(data, at)
    return shingles(scanner.hashes(data, starts, ends), first, width)


def _digests(sets: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two order-free 64-bit sums of each row's set."""
    full = np.flatnonzero(np.diff(at))
    lo, hi = np.zeros(len(at) - 1, np.uint64), np.zeros(len(at) - 1, np.uint64)
    if len(full):
        lo[full] = np.add.reduceat(mix(sets), at[full])
        hi[full] = np.add.reduceat(mix(sets ^ np.uint64(0xA5A5A5A5DEADBEEF)), at[full])
    return lo.view(np.int64), hi.view(np.int64)


def sign(width: int):
    """A mapper from (id, text) to the size, the digests and the MinHash values of each set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, factors = WordScanner(SPACES), _factors()
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            for i, j in slices(offsets):
                at = offsets[i : j + 1] - offsets[i]
                sets, begin = _sets(scanner, data[offsets[i] : offsets[j]], at, width)
                lo, hi = _digests(sets, begin)
                values = np.zeros((j - i, HASHES), np.uint64)
                full = np.flatnonzero(np.diff(begin))
                if len(full):
                    held = np.empty_like(sets)
                    for k in range(HASHES):
                        np.multiply(sets, factors[k], out=held)
                        values[full, k] = np.minimum.reduceat(held, begin[full])
                values = (mix(values) >> np.uint64(48)).astype(np.uint16)
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j].cast(pa.int64()), pa.array(np.diff(begin)), pa.array(lo), pa.array(hi), binary_array(values)], names=["id", "n", "lo", "hi", "sig"])

    return run


def _grow(trees: range, salt: int):
    """A mapper from classes to one row for each tree."""

    def run(batches):
        orders = _orders()
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            data, _ = column_bytes(batch.column(4))
            keys = data.view(np.uint16).reshape(m, HASHES)
            sketch = binary_array(keys[:, TREE_HASHES : TREE_HASHES + SKETCH].astype(np.uint8))
            ids = batch.column(0).to_numpy().astype(np.uint64)
            for t in trees:
                k = np.ascontiguousarray(keys[:, orders[t]]).view(np.int64)
                order = (mix(ids + np.uint64(1_000_003 * (salt + 1) + t)) >> np.uint64(33)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(m, t, np.int32)), pa.array(k[:, 0].copy()), pa.array(k[:, 1].copy()), pa.array(order), batch.column(0), batch.column(1), batch.column(2), batch.column(3), sketch], names=["tree", "k1", "k2", "o", "id", "n", "lo", "comp", "sketch"])

    return run


def _least(share: float, values: int, deviations: float = 4.2) -> int:
    """So many of ``values`` agree at least, but for a few in 100,000, where each does with probability ``share``."""
    return int(np.floor(values * (share - deviations * np.sqrt(share * (1 - share) / values))))


def _look(ahead: int, percent: int):
    """A mapper over sorted tree rows that yields likely pairs of neighbours."""
    least = _least(percent / 100, SKETCH)

    def run(batches):
        kept = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(i).to_numpy() for i in (0, 1, 4, 5, 6, 7)]
            data, _ = column_bytes(batch.column(8))
            cols.append(data.reshape(-1, SKETCH))
            old = 0
            if kept is not None:
                old = len(kept[0])
                cols = [np.concatenate(x) for x in zip(kept, cols)]
            tree, k1, ids, n, lo, comp, sketch = cols
            found = []
            for lag in range(1, min(ahead, len(ids) - 1) + 1):
                i = np.arange(max(lag, old), len(ids))
                j = i - lag
                i = i[(k1[i] == k1[j]) & (tree[i] == tree[j])]
                if not len(i):
                    break
                j = i - lag
                small, large = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
                i = i[(comp[i] != comp[j]) & (100 * small >= percent * large)]
                same = (sketch[i] == sketch[i - lag]).sum(1)
                i, same = i[same >= least], same[same >= least]
                j = i - lag
                up = comp[i] > comp[j]
                found.append((np.where(up, j, i), np.where(up, i, j), same))
            kept = [x[-ahead:].copy() for x in cols]
            if found:
                # the document of the group with the larger number asks; here it keeps its likeliest neighbours of this tree
                a, b, same = (np.concatenate(x) for x in zip(*found))
                order = np.lexsort((a, -same, b))
                order = order[np.arange(len(order)) - np.searchsorted(b[order], b[order]) < NEAREST]
                a, b, same = a[order], b[order], same[order]
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids[a], lo[a], ids[b], lo[b], same.astype(np.int32))], names=["a", "lo_a", "b", "lo_b", "same"])

    return run


def _buckets(batches):
    """A mapper from classes (id, lo, comp, bytes, sig) to each one's bucket in each tree."""
    orders = _orders()[:, : DEPTH // 2]
    for batch in batches:
        m = batch.num_rows
        if m:
            keys = column_bytes(batch.column(4))[0].view(np.uint16).reshape(m, HASHES)
            for t in range(TREES):
                k1 = np.ascontiguousarray(keys[:, orders[t]]).view(np.int64)[:, 0]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(m, t, np.int32)), pa.array(k1.copy()), *batch.columns[:4]], names=["tree", "k1", "id", "lo", "comp", "bytes"])


def _set_rows(width: int):
    """A mapper from (id, text) to (id, lo, shingles): whole sets."""

    def run(batches):
        scanner = WordScanner(SPACES)
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            for i, j in slices(offsets):
                sets, at = _sets(scanner, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], width)
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], pa.array(_digests(sets, at)[0]), ragged_array(sets, at)], names=["id", "lo", "shingles"])

    return run


def _tally(batches):
    for batch in batches:
        slot, n = np.unique(column_bytes(batch.column(0))[0].view(np.uint64) >> np.uint64(64 - SLOT_BITS), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(n)], names=["slot", "n"])


def _ranks(sets: DataFrame) -> np.ndarray:
    """A byte for each counter, larger where more shingles were met."""
    got = sets.select("shingles").mapInArrow(_tally, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << SLOT_BITS, np.uint8)
    out[got.column("slot").to_numpy()] = np.minimum(255, 6 * np.log2(1 + got.column("n").to_numpy()))
    return out


def _rarest(ranks: np.ndarray, percent: int):
    """A mapper from (id, lo, shingles) to (id, lo, rare): the first of the set in the order of all shingles, as sorted keys."""

    def run(batches):
        for batch in batches:
            data, offsets = column_bytes(batch.column(2))
            sets, begin = data.view(np.uint64), offsets // 8
            n = np.diff(begin)
            row = np.repeat(np.arange(len(n)), n)
            keys = (ranks[(sets >> np.uint64(64 - SLOT_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (mix(sets) >> np.uint64(8))
            order = np.lexsort((keys, row))
            most = np.where(n > 0, n + (-percent * n // 100) + 1, 0)
            kept = order[np.arange(len(sets)) - begin[row] < most[row]]
            at = np.zeros(len(n) + 1, np.int64)
            np.cumsum(most, out=at[1:])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), ragged_array(keys[kept], at)], names=["id", "lo", "rare"])

    return run


def _meet(percent: int):
    """A mapper over rows of units (tree, k1, part, asks, id, lo, comp, major, n, sig, rare), sorted by unit.

    Yields the pairs of each asking document that pass both tests and that no earlier tree gives.
    """
    orders = _orders()[:, : DEPTH // 2]
    share = percent / 100
    # one bit of each value is a cheap first test, wide enough to lose nothing that the second would keep
    least, bits = _least(share, HASHES, 5.5), HASHES - _least((1 + share) / 2, HASHES, 6)

    def unit(tree, asks, ids, lo, comp, major, n, sig, rare, first):
        one = np.packbits((sig & 1).astype(np.uint8), axis=1).view(np.uint64)
        asking, told = np.flatnonzero(asks), np.flatnonzero(~asks)
        owner = (np.cumsum(~asks) - 1).repeat(np.diff(first))
        own = (~asks).repeat(np.diff(first))
        tokens, owner = rare[own], owner[own]
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        last = rare[first[told + 1] - 1]
        for i in range(0, len(asking), 128):
            x = asking[i : i + 128]
            unlike = np.zeros((len(x), len(told)), np.uint16)
            for w in range(one.shape[1]):
                unlike += np.bitwise_count(one[x, w][:, None] ^ one[told, w][None, :])
            near = (unlike <= bits) & (comp[x][:, None] != comp[told][None, :])
            # of two that both ask, the one of the larger group number does
            near &= (comp[told] == major[told])[None, :] | (comp[x][:, None] > comp[told][None, :])
            small, large = np.minimum(n[x][:, None], n[told][None, :]), np.maximum(n[x][:, None], n[told][None, :])
            near &= 100 * small >= percent * large
            for r in np.flatnonzero(near.any(1)).tolist():
                mine = rare[first[x[r]] : first[x[r] + 1]]
                low, high = np.searchsorted(tokens, mine, "left"), np.searchsorted(tokens, mine, "right")
                count = high - low
                shared = np.bincount(owner[np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())], minlength=len(told))
                common = -(-percent * (n[x[r]] + n[told]) // (100 + percent))  # that a near pair has at least
                near[r] &= np.searchsorted(mine, last, "right") - shared <= n[x[r]] - common
                near[r] &= np.bincount(owner[: np.searchsorted(tokens, mine[-1], "right")], minlength=len(told)) - shared <= n[told] - common
            p, q = np.nonzero(near)
            for c in range(0, len(p), 1 << 12):
                b, a = x[p[c : c + (1 << 12)]], told[q[c : c + (1 << 12)]]
                equal = sig[a] == sig[b]
                same = equal.sum(1)
                keep = same >= least
                if tree:
                    keep &= ~equal[:, orders[:tree]].all(2).any(1)
                a, b, same = a[keep], b[keep], same[keep]
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(v) for v in (ids[a], lo[a], ids[b], lo[b], same.astype(np.int32))], names=["a", "lo_a", "b", "lo_b", "same"])

    def run(batches):
        held, tail = None, None

        def looked(cols, rare, first, at, cut):
            yield from unit(int(cols[0][at]), *[x[at:cut] for x in cols[3:]], rare[first[at] : first[cut]], first[at : cut + 1] - first[at])

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(9)]
            cols.append(column_bytes(batch.column(9))[0].view(np.uint16).reshape(-1, HASHES))
            data, offsets = column_bytes(batch.column(10))
            rare, first = data.view(np.uint64), offsets // 8
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
                rare, first = np.concatenate([tail[0], rare]), np.concatenate([tail[1], first[1:] + tail[1][-1]])
            tree, k1, part = cols[:3]
            cuts = np.flatnonzero((tree[1:] != tree[:-1]) | (k1[1:] != k1[:-1]) | (part[1:] != part[:-1])) + 1
            at = 0
            for cut in cuts.tolist():
                yield from looked(cols, rare, first, at, cut)
                at = cut
            held, tail = [x[at:].copy() for x in cols], (rare[first[at] :].copy(), first[at:] - first[at])
        if held is not None:
            yield from looked(held, *tail, 0, len(held[0]))

    return run


def _confirm(width: int, percent: int):
    """A mapper over (a, lo_a, b, lo_b, text_a, text_b) that keeps the pairs whose full sets are near enough."""

    def run(batches):
        scanner = WordScanner(SPACES)
        for batch in batches:
            da, oa = column_bytes(batch.column(4))
            db, ob = column_bytes(batch.column(5))
            lo_a, lo_b = batch.column(1).to_numpy(), batch.column(3).to_numpy()
            keep = np.zeros(batch.num_rows, bool)
            for i, j in slices(oa + ob):
                sa, ba = _sets(scanner, da[oa[i] : oa[j]], oa[i : j + 1] - oa[i], width)
                sb, bb = _sets(scanner, db[ob[i] : ob[j]], ob[i : j + 1] - ob[i], width)
                right = (_digests(sa, ba)[0] == lo_a[i:j]) & (_digests(sb, bb)[0] == lo_b[i:j])
                for r in np.flatnonzero(right):
                    both = np.concatenate([sa[ba[r] : ba[r + 1]], sb[bb[r] : bb[r + 1]]])
                    total = len(both)
                    both.sort(kind="stable")
                    common = int((both[1:] == both[:-1]).sum())
                    keep[i + r] = 100 * common >= percent * (total - common)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep)), batch.column(2).filter(pa.array(keep))], names=["a", "b"])

    return run


def _confirm_sets(percent: int):
    """A mapper over (a, b, set_a, set_b) that keeps the pairs whose sets are near enough."""

    def run(batches):
        for batch in batches:
            (da, oa), (db, ob) = column_bytes(batch.column(2)), column_bytes(batch.column(3))
            sa, sb, oa, ob = da.view(np.uint64), db.view(np.uint64), oa // 8, ob // 8
            keep = np.zeros(batch.num_rows, bool)
            for r in range(batch.num_rows):
                both = np.concatenate([sa[oa[r] : oa[r + 1]], sb[ob[r] : ob[r + 1]]])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep[r] = 100 * common >= percent * (len(both) - common)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep)), batch.column(1).filter(pa.array(keep))], names=["a", "b"])

    return run


def _place(c: str):
    return F.pmod(F.xxhash64(c), F.lit(PLACES)).cast("int")


def _confirmed(docs: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs that hold on full texts. Texts of places without any candidate are left where they are."""
    ends = pairs.select(F.col("a").alias("id")).union(pairs.select("b"))
    places = ends.select(_place("id").alias("place")).distinct()
    texts = docs.withColumn("place", _place("id")).join(F.broadcast(places), "place", "left_semi").drop("place")
    one = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    two = one.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    return two.select("a", "lo_a", "b", "lo_b", "text_a", "text_b").mapInArrow(_confirm(width, percent), "a long, b long")


def _grouped(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Adds comp, the group of each id."""
    return rows.join(roots.withColumnsRenamed({"node": "id", "root": "comp"}), "id", "left").withColumn("comp", F.coalesce("comp", "id"))


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose ends are in different groups."""
    for end in ("a", "b"):
        pairs = pairs.join(roots.select(F.col("node").alias(end), F.col("root").alias(f"_{end}")), end, "left")
    return pairs.where(F.coalesce("_a", "a") != F.coalesce("_b", "b")).drop("_a", "_b")


def _settled(sets: DataFrame, queue: DataFrame, roots: DataFrame, percent: int, at: str) -> DataFrame:
    """``roots`` after every pair of ``queue`` (a, lo_a, b, lo_b, same) was confirmed, refuted or found in one group by other links."""
    part = F.pmod(F.xxhash64("a"), F.lit(PARTS))
    rank = F.row_number().over(Window.partitionBy("b", part).orderBy(F.desc("same"), "a", "lo_a", "lo_b"))
    left = written(queue.withColumn("rank", rank).drop("same"), f"{at}/queue")
    most = AT_ONCE
    while (top := left.agg(F.max("rank")).first()[0]) is not None:
        pairs = left.where(F.col("rank") <= most).select("a", "lo_a", "b", "lo_b")
        for end in ("a", "b"):
            pairs = pairs.join(sets.select(F.col("id").alias(end), F.col("lo").alias(f"lo_{end}"), F.col("shingles").alias(f"set_{end}")), [end, f"lo_{end}"])
        fresh = written(pairs.select("a", "b", "set_a", "set_b").mapInArrow(_confirm_sets(percent), "a long, b long"), f"{at}/links-{most}")
        if not fresh.isEmpty():
            roots = joined_components(roots, fresh, f"{at}/components-{most}")
        if top <= most:
            break
        left = written(_apart(left.where(F.col("rank") > most), roots), f"{at}/left-{most}")
        most *= STEP
    return roots


def _bucket_links(docs: DataFrame, classes: DataFrame, roots: DataFrame, width: int, percent: int, at: str) -> DataFrame:
    """``roots`` when no bucket holds an unconfirmed candidate that joins two groups."""
    size = (F.col("n") * PER_SHINGLE + FIXED).cast("long").alias("bytes")
    rows = _grouped(classes.select("id", "lo", "n", "sig"), roots).select("id", "lo", "comp", size, "sig")
    lain = written(rows.mapInArrow(_buckets, "tree int, k1 long, id long, lo long, comp long, bytes long"), f"{at}/lain")
    several = lain.groupBy("tree", "k1").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("tree", "k1")
    met = written(lain.join(several, ["tree", "k1"]), f"{at}/met")
    groups = met.groupBy("tree", "k1", "comp").agg(F.struct(F.count("*").alias("rows"), F.sum("bytes").alias("bytes"), F.col("comp").alias("comp")).alias("g"))
    groups = groups.groupBy("tree", "k1").agg(F.sum("g.rows").alias("rows"), F.sum("g.bytes").alias("bytes"), F.max("g").alias("top"))
    parts = lambda rows, size: F.greatest(F.ceil(rows / UNIT), F.ceil(size / UNIT_BYTES)).cast("long")
    told, asking = parts(F.col("rows"), F.col("bytes")), parts(F.col("rows") - F.col("top.rows"), F.col("bytes") - F.col("top.bytes"))
    mixed = written(groups.select("tree", "k1", F.col("top.comp").alias("major"), told.alias("gm"), asking.alias("ga")), f"{at}/mixed")
    met = met.drop("bytes").join(mixed, ["tree", "k1"])
    ends = written(met.select("id", "lo").distinct(), f"{at}/ends")
    places = ends.select(_place("id").alias("place")).distinct()
    some = docs.withColumn("place", _place("id")).join(F.broadcast(places), "place", "left_semi").join(ends.select("id").distinct(), "id", "left_semi")
    sets = written(some.select("id", "text").mapInArrow(_set_rows(width), "id long, lo long, shingles binary").dropDuplicates(["id", "lo"]), f"{at}/sets")
    rare = sets.mapInArrow(_rarest(_ranks(sets), percent), "id long, lo long, rare binary")
    crowd = written(classes.join(ends, ["id", "lo"], "left_semi").join(rare, ["id", "lo"]).select("id", "lo", "n", "sig", "rare"), f"{at}/crowd")
    # part = the asking side's share of the bucket times gm, and the answering side's
    told = met.select("*", F.lit(False).alias("asks"), F.explode(F.expr("transform(sequence(0, ga - 1), x -> x * gm + pmod(xxhash64(lo, 1), gm))")).alias("part"))
    asking = met.where("comp <> major").select("*", F.lit(True).alias("asks"), F.explode(F.expr("transform(sequence(0, gm - 1), y -> pmod(xxhash64(lo, 2), ga) * gm + y)")).alias("part"))
    units = told.union(asking).join(crowd, ["id", "lo"]).select("tree", "k1", "part", "asks", "id", "lo", "comp", "major", "n", "sig", "rare")
    units = units.repartition("tree", "k1", "part").sortWithinPartitions("tree", "k1", "part")
    looked = written(units.mapInArrow(_meet(percent), "a long, lo_a long, b long, lo_b long, same int"), f"{at}/looked")
    return _settled(sets, looked, roots, percent, at)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row for each row of ``docs``: (id_col, n_shingles, component_id, kept).

    Two documents are linked if 100 * intersection >= percent * union of their sets of ``width``-word shingles.
    """
    spark = docs.sparkSession
    at = shared_dir(spark, "forest")
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    signed = written(docs.mapInArrow(sign(width), "id long, n long, lo long, hi long, sig binary"), f"{at}/signed")
    named = signed.where("id is not null and n > 0")
    classes = written(named.groupBy("n", "lo", "hi").agg(F.min("id").alias("id"), F.first("sig").alias("sig")).select("id", "n", "lo", "hi", "sig"), f"{at}/classes")
    # exact copies reach their class by its key at the end; an id with several texts links the classes of these
    key = F.struct("n", "lo", "hi")
    several = named.groupBy("id").agg(F.min(key).alias("x"), F.max(key).alias("y")).where("x <> y").select("id")
    own = named.join(several, "id", "left_semi").select("n", "lo", "hi", F.col("id").alias("a")).join(classes.select(F.col("id").alias("b"), "n", "lo", "hi"), ["n", "lo", "hi"]).where("a <> b").select("a", "b").distinct()
    roots = None
    for k, (trees, ahead) in enumerate(((range(8), 2), (range(8, TREES), 8))):
        rows = classes.drop("hi")
        rows = rows.withColumn("comp", F.col("id")) if roots is None else _grouped(rows, roots)
        grown = rows.select("id", "n", "lo", "comp", "sig").mapInArrow(_grow(trees, k), "tree int, k1 long, k2 long, o long, id long, n long, lo long, comp long, sketch binary")
        sorted_rows = grown.repartitionByRange("tree", "k1", "k2", "o").sortWithinPartitions("tree", "k1", "k2", "o")
        pairs = written(sorted_rows.mapInArrow(_look(ahead, percent), "a long, lo_a long, b long, lo_b long, same int"), f"{at}/looked-{k}")
        if k == 0:
            pairs = pairs.groupBy("b", "lo_b").agg(F.max(F.struct("same", "a", "lo_a")).alias("x")).select("x.a", "x.lo_a", "b", "lo_b")
        else:
            # several trees may give one pair: a dense rank counts it once
            rank = F.dense_rank().over(Window.partitionBy("b").orderBy(F.desc("same"), "a", "lo_a", "lo_b"))
            pairs = pairs.withColumn("rank", rank).where(F.col("rank") <= LIKELIEST).distinct()
        fresh = written(_confirmed(docs, pairs.select("a", "lo_a", "b", "lo_b"), width, percent), f"{at}/links-{k}")
        if roots is None:
            roots = connected_components(own.union(fresh), f"{at}/components-{k}")
        elif not fresh.isEmpty():
            roots = joined_components(roots, fresh, f"{at}/components-{k}")
    roots = _bucket_links(docs, classes.select("id", "n", "lo", "sig"), roots, width, percent, f"{at}/buckets")
    found = classes.join(roots.withColumnRenamed("node", "id"), "id", "left").select("n", "lo", "hi", F.coalesce("root", "id").alias("root"))
    return (
        signed.select("id", "n", "lo", "hi").join(found, ["n", "lo", "hi"], "left")
        .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("root", "id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))
    )
