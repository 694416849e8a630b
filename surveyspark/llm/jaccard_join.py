"""Near-duplicate documents by an n-gram Jaccard join on a partitioned universe.

A document's set is its distinct 5-word shingles (hashes). Two sets of sizes r and s with
100 * intersection >= pct * union differ in at most H = (r + s) * (100 - pct) // (100 + pct) shingles.

* One pass over the texts deals every shingle out by its hash, as packed arrays; each bucket finds the shingles
  that recur and how often, and sends those alone back to their documents. What no other document holds can be
  in no intersection, so a set of which less than pct percent recur links with nothing and goes. The others go
  on as their recurring shingles, whose intersections are those of the whole sets.
* Sizes fall into bands. In each band the universe of shingles is hashed into N segments, and a set's subset
  in a segment makes one signature (segment and subset). A set also takes part in the band below if a
  smaller partner can lie there.
* Sets that differ in at most H shingles agree in N - H segments at least (pigeonhole); a shingle that does not
  recur is a difference from any partner, so on the recurring ones a set's bound is H less their number. All signatures
  have one global order by cost (how often the subset's rarest shingle was counted; then the hash; empty subsets last).
  A set allocates its bound + 1 to its cheapest signatures and leaves out the others: at least one
  common one is then left in both sets.
* Where H is 1 at most (the smallest sets) the allocation is the whole set as one segment with its
  one-deletion neighbourhood: sets that differ in one shingle meet as "full" and "one deleted".
* Equal sets are one set from the start. Sets that share a signature are never paired as rows: each is tied to the
  first of its signature, the ties make clusters, and a cluster's sets meet in one task, or in tasks of two blocks each
  where they are many. A task counts the common shingles exactly by posting lists and gives back a spanning forest
  of the links, one row for each set at most.

So no link is lost, and the rows that are shuffled grow with the sets, but for clusters of many blocks, whose sets
are repeated once for each block.

Cases: null, empty and blank texts have no shingles and link with nothing; fewer than 5 words make one
shingle; rows that share a doc_id are one node; a null doc_id gets its count and a null component; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from surveyspark.llm.common import Memo, batch_of, id_and_text, mix, ngram_hashes, slices, stored, word_hashes, word_memo

_U = np.uint64
SKETCH_BITS = 22
#: A band's largest size is this many times its smallest.
RATIO = 4
#: Shingles and documents that a task deals out at a time (places take 16 bits).
DEALT, DEALT_DOCS = 1_000_000, 60_000
#: Sets and shingles of a block of a cluster, about.
BLOCK_SETS, BLOCK_SHINGLES = 1000, 2_000_000


def shingle_set(text: bytes, memo: Memo, n: int) -> np.ndarray:
    """The distinct shingles' hashes, sorted. A-Z are lower-cased, words end at ASCII white space."""
    words = text.lower().split()
    if not words:
        return np.empty(0, dtype=_U)
    return np.unique(ngram_hashes(word_hashes(words, memo), min(n, len(words))))


@dataclass(frozen=True)
class Band:
    number: int
    low: int  # of a pair's smaller set
    high: int
    top: int  # of its larger set
    whole: bool  # one segment with one-deletion neighbourhood
    segments: int


def bands(size: int, pct: int) -> list[Band]:
    """The bands in which a set of ``size`` shingles takes part."""
    high = 1  # the first band: a difference of one at most
    while (high + 1 + (high + 1) * 100 // pct) * (100 - pct) // (100 + pct) <= 1:
        high += 1
    low, number, out = 1, 0, []
    while low <= size:
        top = high * 100 // pct
        if size <= top:
            out.append(Band(number, low, high, top, number == 0, 2 * top))
        low, high, number = high + 1, (high + 1) * RATIO - 1, number + 1
    return out


def budget(band: Band, size: int, pct: int) -> int:
    """H + 1 for the largest partner in the band."""
    partner = min(size * 100 // pct, band.top) if size <= band.high else band.high
    return (size + partner) * (100 - pct) // (100 + pct) + 1


def common_least(low_n: Column, high_n: Column, low_p: Column, high_p: Column, pct: int) -> Column:
    """How many signatures two sets that link have in common at least.

    Of the N - H segments in which they agree, the j-th cheapest is at most the (j + H)-th of each set, so the
    first min(budget, budget) - H of them are in both allocations. 1 for nodes that stand for several sets."""
    small, large = F.least(high_n, high_p), F.greatest(high_n, high_p)
    share = lambda total: F.floor(total * (100 - pct) / (100 + pct))
    out = F.lit(1)
    every = {b.number: b for k in range(41) for b in bands(1 << k, pct)}  # sets of up to 2^40 shingles
    for band in every.values():
        if not band.whole:
            mine = lambda n, b=band: share(n + F.when(n <= b.high, F.least(F.floor(n * 100 / pct), F.lit(b.top))).otherwise(F.lit(b.high))) + 1
            out = F.when(small.between(band.low, band.high), F.least(mine(small), mine(large)) - share(small + large)).otherwise(out)
    return F.when((low_n == high_n) & (low_p == high_p), F.greatest(out, F.lit(1))).otherwise(F.lit(1))


def signatures(shingles: np.ndarray, band: Band, pct: int, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signature, full, cost) of a whole set in a band, its shingles' counts taken from a sketch."""
    return allocation(shingles, sketch[(shingles >> _U(64 - SKETCH_BITS)).astype(np.int64)], len(shingles), band, pct)


def allocation(shingles: np.ndarray, counts: np.ndarray, size: int, band: Band, pct: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signature, full, cost) of a set of ``size`` shingles in a band, given those that recur and their counts."""
    content, place = mix(shingles + _U(0x51ED270B)), _U(0x2545F4914F6CDD1D * (band.number + 1) & 0xFFFFFFFFFFFFFFFF)
    alone = size - len(shingles)
    if band.whole:
        total = content.sum(dtype=_U)
        parts = [total] if alone == 1 else [total, *(total - content if size > 1 else ())] if not alone else []
        out = mix(np.array(parts, dtype=_U) + place)
        return out, (np.arange(len(out)) == 0) & (alone == 0), np.zeros(len(out), dtype=np.int64)
    k = budget(band, size, pct) - alone
    if k <= 0:
        return np.empty(0, dtype=_U), np.empty(0, dtype=bool), np.empty(0, dtype=np.int64)
    segment = (mix(shingles + place) % _U(band.segments)).astype(np.int64)
    order = np.argsort(segment)  # sums and minima do not depend on the order within a segment
    own = segment[order]
    starts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
    total = np.add.reduceat(content[order], starts)
    cost = np.minimum.reduceat(counts[order], starts)
    sig = mix(total + mix(own[starts].astype(_U) + place))
    if len(sig) < k:  # empty subsets, in their own order
        empty = mix(mix(np.setdiff1d(np.arange(band.segments), own[starts]).astype(_U) + place))
        sig, cost = np.concatenate((sig, np.sort(empty))), np.concatenate((cost, np.full(len(empty), 1 << 40)))
    best = np.lexsort((sig, cost))[:k]
    return sig[best], np.ones(len(best), dtype=bool), cost[best]


#: Rows of the deal. Of a group of documents (bucket -1): their ids, sizes and digests. Of a group's shingles in a bucket:
#: hash and place in the group, packed; of those that recur, also the ranks of their counts.
DEAL = pa.schema([("deal", pa.int64()), ("bucket", pa.int32()), ("ids", pa.list_(pa.int64())), ("numbers", pa.binary()), ("data", pa.binary())])
DEAL_SQL = "deal long, bucket int, ids array<long>, numbers binary, data binary"


def _packed(keys: np.ndarray, places: np.ndarray) -> bytes:
    """40 bits of hash and 16 of place: 7 bytes a shingle, for these are all that is shuffled of most documents."""
    return keys.astype("<u4").tobytes() + (keys >> _U(32)).astype("u1").tobytes() + places.astype("<u2").tobytes()


def _unpacked(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    sizes = [len(p) // 7 for p in parts]
    low, high, places = (np.concatenate([np.frombuffer(p, kind, m, at * m) for p, m in zip(parts, sizes, strict=True)] or [np.empty(0, dtype=kind)]) for kind, at in (("<u4", 0), ("u1", 4), ("<u2", 5)))
    return high.astype(_U) << _U(32) | low.astype(_U), places.astype(np.int64)


def _rank(counts: np.ndarray) -> np.ndarray:
    """A count's place in the order of costs: tenths of its binary logarithm, in a byte."""
    return np.minimum(10 * np.log2(counts), 255).astype("u1")


def _deal(n: int, bits: int):
    """The shingles of all texts, dealt into 2 ** bits buckets by hash; 40 more bits tell those of a bucket apart."""

    def dealt(deal: int, ids: list, sets: list[np.ndarray]) -> pa.RecordBatch:
        sizes = np.fromiter(map(len, sets), dtype="<i4", count=len(sets))
        digests = b"".join([xxhash.xxh3_128_digest(s.tobytes()) for s in sets])
        shingles = np.concatenate(sets)
        bucket = (shingles >> _U(64 - bits)).astype(np.uint16)
        order = np.argsort(bucket, kind="stable")
        keys, places = (shingles << _U(bits) >> _U(24))[order], np.repeat(np.arange(len(sets)), sizes)[order]
        at = np.concatenate(([0], np.cumsum(np.bincount(bucket, minlength=1 << bits))))
        used = np.flatnonzero(np.diff(at))
        rows = [(deal, -1, ids, sizes.tobytes(), digests)]
        rows += [(deal, k, None, None, _packed(keys[at[k] : at[k + 1]], places[at[k] : at[k + 1]])) for k in used.tolist()]
        return batch_of(DEAL, *zip(*rows, strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        memo, deal, ids, sets, held = word_memo(), TaskContext.get().partitionId() << 32, [], [], 0
        for batch in slices(batches):
            memo.trim()
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids.append(doc_id)
                sets.append(shingle_set((text or "").encode(), memo, n))
                held += len(sets[-1])
                if held >= DEALT or len(ids) >= DEALT_DOCS:
                    yield dealt(deal, ids, sets)
                    deal, ids, sets, held = deal + 1, [], [], 0
        if ids:
            yield dealt(deal, ids, sets)

    return run


def _recurring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket: of each bucket the shingles that more than one document holds, with their counts."""

    def found(bucket: int, deals: list[int], parts: list[bytes]) -> pa.RecordBatch:
        keys, places = _unpacked(parts)
        ordered = np.sort(keys)
        twice, counts = np.unique(ordered[1:][ordered[1:] == ordered[:-1]], return_counts=True)
        at = np.searchsorted(twice, keys)
        kept = np.flatnonzero(np.append(twice, _U(0xFFFFFFFFFFFFFFFF))[at] == keys)
        ends = np.searchsorted(kept, np.cumsum([len(p) // 7 for p in parts]))
        keys, places, ranks = keys[kept], places[kept], _rank(counts + 1)[at[kept]]
        rows, start = [], 0
        for deal, end in zip(deals, ends.tolist(), strict=True):
            if end > start:
                rows.append((deal, bucket, None, ranks[start:end].tobytes(), _packed(keys[start:end], places[start:end])))
            start = end
        return batch_of(DEAL, *(zip(*rows, strict=True) if rows else [[]] * len(DEAL)))

    last, deals, parts = -1, [], []
    for batch in batches:
        buckets = batch.column(1).to_pylist()
        heads = buckets.count(-1)
        if heads:
            yield batch.slice(0, heads)
        for deal, bucket, data in zip(batch.column(0).to_pylist()[heads:], buckets[heads:], batch.column(4).slice(heads), strict=True):
            if bucket != last:
                if parts:
                    yield found(last, deals, parts)
                last, deals, parts = bucket, [], []
            deals.append(deal)
            parts.append(data.as_py())
    if parts:
        yield found(last, deals, parts)


PROFILE = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("shingles", pa.binary()), ("ranks", pa.binary())])


def _gathered(pct: int):
    """Rows sorted by deal and bucket: per document its size, digest and, if enough of its shingles recur, these and the ranks of their counts."""

    def profile(ids: pa.Array, sizes: bytes, digests: bytes, parts: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
        n, digest = np.frombuffer(sizes, dtype="<i4").astype(np.int64), np.frombuffer(digests, dtype=">i8").astype(np.int64)
        keys, place = _unpacked([p[2] for p in parts])
        bucket = np.repeat(np.array([p[0] for p in parts], dtype=_U), [len(p[1]) for p in parts])
        ranks = np.frombuffer(b"".join([p[1] for p in parts]), dtype="u1")
        enough = (n > 0) & (100 * np.bincount(place, minlength=len(n)) >= pct * n)
        kept = np.flatnonzero(enough[place])
        kept = kept[np.argsort(place[kept], kind="stable")]
        values, ranks = (bucket[kept] << _U(40)) | keys[kept], ranks[kept]
        at = np.concatenate(([0], np.cumsum(np.bincount(place[kept], minlength=len(n)))))
        pick = lambda x: [x[at[k] : at[k + 1]].tobytes() if ok else None for k, ok in enumerate(enough.tolist())]
        return batch_of(PROFILE, ids, n, digest[::2], digest[1::2], pick(values), pick(ranks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, parts = None, []
        for batch in batches:
            for k, (bucket, numbers, data) in enumerate(zip(*(batch.column(c).to_pylist() for c in (1, 3, 4)), strict=True)):
                if bucket >= 0:
                    parts.append((bucket, numbers, data))
                    continue
                if head:
                    yield profile(*head, parts)
                head, parts = (batch.column(2)[k].values, numbers, data), []
        if head:
            yield profile(*head, parts)

    return run


def profiles(given: DataFrame, n: int, pct: int) -> DataFrame:
    """(doc_id, n, d1, d2, shingles, ranks) of each row: size and digest of its set; its recurring shingles if it can link."""
    partitions = int(given.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = min(max(8, (4 * partitions - 1).bit_length()), 16)
    deal = given.mapInArrow(_deal(n, bits), DEAL_SQL)
    by_bucket = deal.repartition(F.when(F.col("bucket") < 0, F.col("deal")).otherwise(F.col("bucket").cast("long"))).sortWithinPartitions("bucket")
    by_deal = by_bucket.mapInArrow(_recurring, DEAL_SQL).repartition("deal").sortWithinPartitions("deal", "bucket")
    return by_deal.mapInArrow(_gathered(pct), "doc_id long, n long, d1 long, d2 long, shingles binary, ranks binary")


ENTRY = pa.schema([("sig", pa.int64()), ("node", pa.int64()), ("full", pa.bool_())])


def _entries(pct: int):
    """A row for each signature of each set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                sigs, owners, fulls = [], [], []
                for node, n, shingles, ranks in zip(*(c.to_pylist() for c in batch.slice(at, 500).columns), strict=True):
                    for band in bands(n, pct):
                        sig, full, _ = allocation(np.frombuffer(shingles, dtype=_U), np.frombuffer(ranks, dtype="u1").astype(np.int64), n, band, pct)
                        sigs.append(sig)
                        owners.append(np.full(len(sig), node))
                        fulls.append(full)
                if sigs:
                    yield batch_of(ENTRY, np.concatenate(sigs).view(np.int64), np.concatenate(owners), np.concatenate(fulls))

    return run


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def links(nodes: list[int], sizes: list[int], sets: list[np.ndarray], sides: list[int], pct: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between sets of one side, or of different sides if there are two."""
    two = len(set(sides)) == 2
    n, side, up = np.array(sizes), np.array(sides), list(range(len(nodes)))
    lengths = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
    owner, (_, number, held) = np.repeat(np.arange(len(sets)), lengths), np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    of, posted = np.split(number, np.cumsum(lengths)[:-1]), owner[np.argsort(number, kind="stable")]
    ends = np.cumsum(held)
    starts = (ends - held).tolist()
    ends = ends.tolist()

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    out = []
    for q in range(1, len(nodes)):
        if two and sides[q] == sides[0]:  # sorted by side: the second side is tested against the first
            continue
        common = np.bincount(np.concatenate([posted[starts[k] : ends[k]] for k in of[q].tolist()]), minlength=len(nodes))[:q]
        linked = 100 * common >= pct * (n[:q] + n[q] - common)
        for other in np.flatnonzero(linked & (side[:q] != side[q]) if two else linked).tolist():
            a, b = root(other), root(q)
            if a != b:
                up[b] = a
                out.append((nodes[other], nodes[q]))
    return out


def _link(pct: int):
    """Rows (cluster, low, high, side, node, n, shingles) sorted by the first four."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, rows = None, []

        def found() -> Iterator[pa.RecordBatch]:
            nodes, sizes, sets, sides = zip(*rows, strict=True)
            if len(rows) > 1 and (pairs := links(nodes, sizes, sets, sides, pct)):
                yield batch_of(LINKS, *zip(*pairs, strict=True))

        for batch in batches:
            for cluster, low, high, side, node, n, shingles in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (cluster, low, high) != last:
                    if rows:
                        yield from found()
                    last, rows = (cluster, low, high), []
                rows.append((node, n, np.frombuffer(shingles, dtype=_U), side))
        if rows:
            yield from found()

    return run


def linked(sets: DataFrame, pct: int) -> DataFrame:
    """Links (a, b) between the nodes of sets (node, n, shingles, ranks) that join all that are linked, and more than once maybe."""
    entries = sets.select("node", "n", "shingles", "ranks").mapInArrow(_entries(pct), "sig long, node long, full boolean")
    # streaming frames: a signature's sets are never held together
    so_far = W.partitionBy("sig").orderBy(F.desc("full"), "node").rowsBetween(W.unboundedPreceding, W.currentRow)
    ties = entries.withColumn("head", F.first(F.when(F.col("full"), F.col("node"))).over(so_far)).where("head <> node")
    clusters = components(ties.select(F.least("head", "node").alias("a"), F.greatest("head", "node").alias("b")))
    members = stored(sets.select("node", "n", "shingles").join(clusters, F.col("node") == F.col("id")).drop("id"), "clustered-sets")
    many = members.groupBy("component").agg(F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum(F.length("shingles")) / (8 * BLOCK_SHINGLES))).cast("int").alias("blocks"))
    blocks = members.join(many, "component").withColumn("side", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("component", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side", "node", "n", "shingles")
    return dealt.repartition("component", "low", "high").sortWithinPartitions("component", "low", "high", "side").mapInArrow(_link(pct), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the least id reachable over edges (a, b), by contracting each node to its least neighbour until no edge is left."""
    names = None
    edges = stored(edges.select("a", "b").where("a <> b").distinct(), "component-edges")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("up")), "component-steps")
        if names is None:
            names = up.select(F.col("a").alias("id"), F.col("up").alias("component"))
        else:
            names = names.join(up, names.component == up.a, "left").select("id", F.coalesce("up", "component").alias("component"))
        names = stored(names, "component-names")
        if edges.isEmpty():
            return names
        ends = edges.join(up, "a").select(F.col("up").alias("x"), "b").join(up.withColumnRenamed("a", "b"), "b").select("x", F.col("up").alias("y"))
        edges = stored(ends.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "component-edges")


def _ordered(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.where(F.col(x) != F.col(y)).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))


def near_duplicates(docs: DataFrame, *, pct: int = 75, n: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the least doc_id reachable by links, itself included)."""
    profile = stored(profiles(id_and_text(docs, id_col, text_col), n, pct), "set-profiles")
    rows = profile.drop("shingles", "ranks")
    sets = stored(rows.where("n > 0 and doc_id is not null").groupBy("d1", "d2").agg(F.min("doc_id").alias("node")), "sets")
    # a doc_id with different texts links their sets
    several = rows.where("n > 0 and doc_id is not null").groupBy("doc_id").agg(*(f(c).alias(f.__name__ + c) for f in (F.min, F.max) for c in ("d1", "d2"))).where("mind1 <> maxd1 or mind2 <> maxd2").select("doc_id")
    same_doc = _ordered(rows.join(several, "doc_id").join(sets, ["d1", "d2"]), "doc_id", "node").distinct()
    able = profile.where("shingles is not null").join(sets, ["d1", "d2"]).where("doc_id = node").dropDuplicates(["d1", "d2"])
    found = linked(stored(able.select("node", "n", "shingles", "ranks"), "sets-that-can-link"), pct)
    names = components(found.unionByName(same_doc))
    named = sets.join(names, F.col("node") == names.id, "left").select("d1", "d2", F.coalesce("component", "node").alias("component"))
    out = rows.join(named, ["d1", "d2"], "left")
    # rows that share a doc_id share a node, whichever of their sets it was that linked
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))).alias("component_id"))
