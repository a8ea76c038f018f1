"""Near-duplicate join on word shingles with adaptive multi-match prefixes.

Documents are sets of hashed shingles (64 bits; equal hashes count as equal shingles). Shingles
are ordered by estimated frequency, the rarest first. Two sets that are similar enough share at
least l shingles among the first n - ceil(0.75 n) + l of each, for any l; every document chooses
its own l, as many as its frequent shingles make worth while: a longer prefix costs a few rows,
but a partner must then share as many more shingles before it is verified (``required``).

Copies are one node, so the work is between different sets:

1. A sketch of all shingles (fixed size) gives frequencies for the order and for the choice of l;
   it decides on cost only, never on results.
2. Each shingle that several nodes have in their prefix names a pivot, the node that shares most
   shingles; pivot and members are verified. That is linear in the rows of a hot shingle, and it
   joins groups of near copies to components.
3. Where a shingle is still shared by several components, pairs across components are counted and
   verified. Pairs within a component cannot add to it. So no link between components is lost and
   no group is expanded into all its pairs.

Verification fetches whole sets of the nodes in question and intersects them. Components are
found by alternating stars. Intermediate tables are written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from snapstar.llm.text import WORD, mixed, shingles, table, word_hashes
from snapstar.session import new_folder, released, small_batches

WIDTH, PERCENT = 5, 75
SKETCH_BITS, BLOOM_BITS = 18, 24
MOST_MATCHES = 8
#: Shingles that a row remembers, so that a pair is met at the first of a run it shares.
BEFORE = 3
#: Bounds of the classes that shared shingles are counted in, by their number of nodes.
RARITY = (4, 32, 512)
_HELD = tuple(f"held{k}" for k in range(len(RARITY) + 1))
#: Up to this many of a node's shared shingles are counted for the choice of pivots.
MOST_HELD = 32767
#: Words of 64 bits in which a whole set marks its shingles (a power of two).
SIEVE = 64
#: Costs of a row in the prefix and of a candidate, for the choice of l.
ROW_COST, CANDIDATE_COST = 1.0, 4.0


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    return shingles(word_hashes(text)[0], width)


def node_of(held: np.ndarray) -> int | None:
    """A 64-bit name of a set; sets of equal names count as equal. None for the empty set."""
    if len(held) == 0:
        return None
    total = np.add.reduce(mixed(held + np.uint64(0xA5A5A5A5)))
    other = np.bitwise_xor.reduce(mixed(held * np.uint64(0x9E3779B97F4A7C15)))
    one = np.array([total + np.uint64(len(held))])
    return int(mixed(mixed(one) + other).view(np.int64)[0])


def needed(n: int, percent: int = PERCENT) -> int:
    """Shingles that a set of n must share with any partner."""
    return -(-percent * n // 100)


def sketch(docs: DataFrame, text: str, width: int) -> np.ndarray:
    """Counts of all shingles by the leading bits of their hash."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            for value in batch.column(0):
                held = shingle_set(value.as_py(), width)
                np.add.at(total, (held >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(total[used])], names=["bucket", "n"])

    counts = docs.select(text).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(
        F.sum("n").alias("n"))
    with small_batches(docs.sparkSession):
        rows = counts.toArrow()  # one row a bucket at most
    out = np.zeros(1 << SKETCH_BITS)
    out[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return out


def excess(counts: np.ndarray) -> np.ndarray:
    """Estimated documents of a bucket's most frequent shingle beyond the first."""
    usual = np.median(counts)
    return np.maximum(0, counts - usual - 4 * np.sqrt(usual + 1)).astype(np.float32)


def matches(costs: np.ndarray, n: int, percent: int = PERCENT) -> int:
    """The l with the least estimated cost; costs: of the ordered shingles' candidates."""
    base = n - needed(n, percent)
    most = max(1, min(MOST_MATCHES, needed(n, percent)))
    sums = np.cumsum(costs[:base + most])
    choice = [
        ROW_COST * (base + k) + CANDIDATE_COST * float(sums[min(base + k, n) - 1]) / k
        for k in range(1, most + 1)
    ]
    return 1 + int(np.argmin(choice))


def _signer(frequent: np.ndarray, width: int, percent: int):
    level = np.ceil(np.log2(1 + frequent)).astype(np.int8)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            n, nodes, least, prefixes = [], [], [], []
            for value in batch.column(1):
                held = shingle_set(value.as_py(), width)
                node = node_of(held)
                n.append(len(held))
                nodes.append(node)
                # Copies in a task share the prefix of the first.
                if node is None or node in seen:
                    least.append(None)
                    prefixes.append(None)
                    continue
                seen.add(node)
                bucket = (held >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)
                order = np.argsort(level[bucket], kind="stable")
                k = matches(frequent[bucket[order]], len(held), percent)
                least.append(k)
                size = len(held) - needed(len(held), percent) + k
                prefixes.append(held[order[:size]].view(np.int64))
            if len(seen) > 1_000_000:
                seen.clear()
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(n, pa.int64()), pa.array(nodes, pa.int64()),
                pa.array(least, pa.int32()), pa.array(prefixes, pa.list_(pa.int64())),
            ], names=["key", "n", "node", "least", "prefix"])
    return sign


def _stored(rows: DataFrame, purpose: str) -> DataFrame:
    """``rows`` written to the shared folder and read again; survives any executor.

    What was shuffled for them is given back at once.
    """
    folder = new_folder(rows.sparkSession, purpose)
    with small_batches(rows.sparkSession), released(rows.sparkSession):
        rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def possible(a: str, b: str, percent: int = PERCENT) -> Column:
    """Whether a common shingle leaves room for enough others (n_, at_ and place_ of a and b).

    at: shingles of the set before it in the common order; place: those of them that the two can
    have in common at all.
    """
    n, m, i, j = (F.col(x) for x in (f"n{a}", f"n{b}", f"at{a}", f"at{b}"))
    most = F.least(f"place{a}", f"place{b}") + F.least(n - i, m - j)
    return (F.least(n, m) * (100 + percent) >= percent * (n + m)) & (
        most * (100 + percent) >= percent * (n + m))


def required(a: str = "1", b: str = "2", percent: int = PERCENT) -> Column:
    """Shingles that a pair must share within its two prefixes (n_, least_ of a and b).

    The prefix that ends first in the common order is seen whole by the other, so all else that
    the pair shares lies in the needed(n) - l shingles behind it. This is at least the smaller l.
    """
    n, m, k, l = (F.col(x) for x in (f"n{a}", f"n{b}", f"least{a}", f"least{b}"))  # noqa: E741
    up = lambda x, y: F.ceil(x * percent / y)
    both = up((n + m).cast("long"), 100 + percent)
    return both - F.greatest(up(n.cast("long"), 100) - k, up(m.cast("long"), 100) - l)


#: n, at and least of a row in one number, as they are dealt.
_PACKED = "shiftleft(CAST(n AS BIGINT), 32) | shiftleft(CAST(at AS BIGINT), 4) | least"


def _unpacked(node: str, size: str, side: str) -> list[Column]:
    at = F.shiftright(size, 4).bitwiseAND(F.lit((1 << 28) - 1)).cast("int")
    return [
        F.col(node).alias(f"node{side}"), F.shiftright(size, 32).cast("int").alias(f"n{side}"),
        at.alias(f"at{side}"), F.col(size).bitwiseAND(F.lit(15)).cast("int").alias(f"least{side}")]


def shared_rows(signed: DataFrame) -> DataFrame:
    """(token, node, n, at, least) of prefix shingles that several nodes have."""
    # Dealt by shingle once; the extremes and the join below both read that one shuffle.
    packed = signed.where("prefix IS NOT NULL").select(
        "node", F.expr("shiftleft(n, 32) | least").alias("size"),
        F.posexplode("prefix").alias("at", "token")
    ).select(
        "token", "node", F.expr("size | shiftleft(CAST(at AS BIGINT), 4)").alias("size")
    ).repartition("token")
    at = F.expr("CAST(shiftright(size, 4) & 268435455 AS INT)")
    rank = F.shiftleft(F.least(at, F.lit(32767)).cast("long"), 48).bitwiseOR(
        F.expr("node & 281474976710655"))
    # Equal ranks are the same node: of nodes at one place, 48 bits of the name tell them apart.
    several = packed.groupBy("token").agg(
        F.min(rank).alias("first"), F.max(rank).alias("last")
    ).where("first < last").select("token")
    return packed.join(several, "token").select(
        "token", "node", F.shiftright("size", 32).cast("int").alias("n"), at.alias("at"),
        F.expr("CAST(size & 15 AS INT)").alias("least"))


def with_pivots(shared: DataFrame) -> DataFrame:
    """(token, node2, n2, ..., held2, node1, n1, ..., held1): the rows, each with its shingle's pivot as 1.

    The pivot is the node with most shared shingles. Of copies with edits, the one nearest to the
    others has lost fewest; it is the pivot of all shingles it has, so a member meets few pivots.
    held counts a node's shared shingles, up to ``MOST_HELD``.
    """
    # A window over one node holds no more than its own prefix. Its rows are dealt by shingle once,
    # for the maximum and for the join: both read all columns, and none is null, or the join would
    # filter nulls first and be dealt apart.
    rows = shared.withColumn("held", F.least(
        F.count("*").over(Window.partitionBy("node")), F.lit(MOST_HELD))).select(
        "token", "held", F.coalesce("node", F.lit(0)).alias("node"),
        F.coalesce(F.expr(_PACKED), F.lit(0)).alias("size"),
    ).select(
        "token", "node", "size", F.expr("shiftleft(held, 48) | (node & 281474976710655)").alias("score")
    ).repartition("token")
    top = rows.groupBy("token").agg(F.max(F.struct("score", "node", "size")).alias("top"))
    return rows.join(top, "token").where(F.col("score") <= F.col("top.score")).select(
        "token", *_unpacked("node", "size", "2"), F.shiftright("score", 48).alias("held2"),
        *_unpacked("top.node", "top.size", "1"), F.shiftright("top.score", 48).alias("held1"))


def counted(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that share as many of the ``rows``' shingles as they must.

    A node's shingles travel as one array, no longer than its prefix.
    """
    own = rows.groupBy("node").agg(
        F.max("n").alias("n"), F.max("least").alias("least"), F.collect_list("token").alias("tokens"))
    one, two = (own.select(
        F.col("node").alias(name), F.col("n").alias(f"n{k}"), F.col("least").alias(f"least{k}"),
        F.col("tokens").alias(f"tokens{k}")) for k, name in ((1, "a"), (2, "b")))
    return pairs.join(one, "a").join(two, "b").where(
        F.size(F.array_intersect("tokens1", "tokens2")) >= required(percent=percent)
    ).select("a", "b")


def _bloom(keys: DataFrame, key: str) -> np.ndarray:
    """Bits of the keys' hashes, of fixed size; when it is full, all keys pass."""
    at = F.pmod(F.xxhash64(key), F.lit(1 << BLOOM_BITS))
    rows = keys.select(at.alias("at")).groupBy(F.floor(F.col("at") / 32).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(at % 32 AS INT))")).alias("bits")
    ).toArrow()
    out = np.zeros(1 << BLOOM_BITS - 5, np.int64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return out


def drawn(held: np.ndarray) -> np.ndarray:
    """``SIEVE`` words of 64 bits in which each shingle of a set marks one bit by its hash."""
    out = np.zeros(SIEVE * 64, bool)
    out[(held & np.uint64(SIEVE * 64 - 1)).astype(np.int64)] = True
    return np.packbits(out).view(np.int64)


def sieved(pairs: DataFrame, whole: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that can be similar enough by the sizes and bits of their sets.

    A bit that the other lacks is at least one shingle that the other lacks, so no link is lost.
    """
    one, two = (whole.select(
        F.col("node").alias(name), F.size("held").alias(f"n{k}"), F.col("bits").alias(f"bits{k}"),
    ) for k, name in ((1, "a"), (2, "b")))

    def common(x: str, y: str) -> Column:
        lacking = F.zip_with(f"bits{x}", f"bits{y}", lambda i, j: F.bit_count(
            i.bitwiseAND(F.bitwise_not(j))))
        return F.col(f"n{x}") - F.aggregate(lacking, F.lit(0), lambda total, i: total + i)

    return pairs.join(one, "a").join(two, "b").where(
        F.least(common("1", "2"), common("2", "1")) * (100 + percent)
        >= percent * (F.col("n1") + F.col("n2"))).select("a", "b")


def verified(
    pairs: DataFrame, nodes: DataFrame, docs: DataFrame, key: str, text: str,
    width: int, percent: int, doubtful: bool = False,
) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough. nodes: (node, first key).

    Most of ``doubtful`` pairs are not; they meet the small ``bits`` of their sets first, so that few
    whole sets travel.
    """
    asked = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    asked = _stored(asked.join(nodes, "node"), "asked")
    bloom = _bloom(asked, "first")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            at = batch.column(0).to_numpy(zero_copy_only=False)
            some = np.flatnonzero(bloom[at >> 5] >> (at & 31) & 1)
            names, held, bits = [], [], []
            for k in some.tolist():
                own = shingle_set(batch.column(1)[k].as_py(), width)
                node = node_of(own)
                if node is not None and node not in seen:
                    seen.add(node)
                    names.append(node)
                    held.append(own.view(np.int64))
                    bits.append(drawn(own) if doubtful else None)
                if len(names) == 500:
                    yield sets_of(names, held, bits)
                    names, held, bits = [], [], []
            if len(seen) > 1_000_000:
                seen.clear()
            yield sets_of(names, held, bits)

    def sets_of(names: list, held: list, bits: list) -> pa.RecordBatch:
        kind = pa.list_(pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.int64()), pa.array(held, kind), pa.array(bits, kind)],
            names=["node", "held", "bits"])

    whole = docs.select(
        F.pmod(F.xxhash64(key), F.lit(1 << BLOOM_BITS)).alias("at"), F.col(text).alias("text")
    ).mapInArrow(sets, "node long, held array<long>, bits array<long>")
    # The few sets that pass the bits unasked meet no pair below.
    whole = _stored(whole, "sets")
    if doubtful:
        pairs = _stored(sieved(pairs, whole, percent), "sieved")
        likely = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        whole = whole.join(likely, "node", "left_semi")

    both = F.size(F.array_intersect("one", "two"))
    union = F.size("one") + F.size("two") - both
    return pairs.join(whole.select(F.col("node").alias("b"), F.col("held").alias("two")), "b").join(
        whole.select(F.col("node").alias("a"), F.col("held").alias("one")), "a"
    ).where(100 * both >= percent * union).select("a", "b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, comp): the least node reachable from each node of ``links`` (a, b), by two stars.

    Each round links every node's larger neighbours, then its smaller ones, to the least of all;
    rounds end when the links no longer change, after about the logarithm of the longest path.
    """
    def star(held: DataFrame, larger: bool) -> DataFrame:
        both = held.unionByName(held.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if not larger:
            both = both.where("b < a")
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("to"))
        out = both.join(least, "a")
        if larger:
            out = out.where("b > a").select(F.col("b").alias("a"), F.col("to").alias("b"))
        else:
            out = out.select(F.col("b").alias("a"), F.col("to").alias("b")).unionByName(
                least.select("a", F.col("to").alias("b")))
        return out.where("a <> b").distinct()

    held = _stored(
        links.where("a <> b").select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        now = held.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").bitwiseAND(F.lit((1 << 31) - 1)))).first()
        if now == state or not now[0]:
            break
        state = now
        held = _stored(star(star(held, True), False), "links")
    return held.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(
        held.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())


def open_rows(shared: DataFrame, comps: DataFrame, percent: int) -> DataFrame:
    """Rows whose shingle may still link two components: with comp, place, before and held.

    held0 and on count a node's shingles that other components share, by how many nodes do; place
    counts those before a row's and before names the last of them. A pair cannot have more in
    common (``in_common``). A row goes if that is too little for any size of the nodes that share
    its shingle, and with the rows go shingles that are left to one component. Those are most: a
    passage of many documents is a small part of each, and an edited copy of a much copied text
    has lost too many of its shingles to link with anything but its nearest kin. No row of a pair
    that links can go.
    """
    # Twice the rows are dealt by shingle, each time once for the extremes and the join; both read
    # all columns, or they would be dealt apart.
    placed = shared.join(comps, "node", "left").select(
        "token", "node", F.coalesce("comp", "node").alias("comp"), F.expr(_PACKED).alias("size")
    ).repartition("token")
    kept = placed.join(_several(placed), "token").select(
        "token", *_unpacked("node", "size", ""), "comp", "low", "high", "nodes")
    # Windows over one node hold no more than its own prefix.
    whole = Window.partitionBy("node")
    rank = sum((F.col("nodes") > most).cast("int") for most in RARITY)
    kept = kept.withColumns({
        name: F.sum((rank == k).cast("int")).over(whole).cast("int") for k, name in enumerate(_HELD)
    }).withColumns({
        "place": F.row_number().over(Window.partitionBy("node").orderBy("at")) - 1,
        "before": F.collect_list("token").over(
            Window.partitionBy("node").orderBy("at").rowsBetween(-BEFORE, -1)),
    })
    held = sum(F.col(name) for name in _HELD)
    up = lambda x, y: F.ceil(x * percent / y)
    n = F.col("n").cast("long")

    def enough(m: Column) -> Column:
        own, other = percent * n - 100 * F.col("least"), percent * m - 100
        demand = 100 * percent * (n + m) - (100 + percent) * F.greatest(own, other)
        return demand < (held + 1) * (100 * (100 + percent))

    # Without rounding the demand is concave in the size, so the extremes decide; rounding lowers it
    # by less than one.
    least = F.greatest(F.col("low"), up(n, 100))
    most = F.least(F.col("high"), F.floor(n * 100 / percent))
    kept = kept.where(
        (((least <= n) & enough(least)) | ((most >= n) & enough(most)))
        & (n - F.col("at") + F.col("place") >= up(n + least, 100 + percent))
    ).drop("low", "high", "nodes")
    # The rows may meet themselves without being dealt again: as above, none is null.
    kept = kept.select("token", *[
        name if name == "before" else F.coalesce(name, F.lit(0)).alias(name)
        for name in kept.columns if name != "token"]).repartition("token")
    rest = [name for name in kept.columns if name not in ("token", "comp")]
    several = kept.groupBy("token").agg(
        F.min("comp").alias("c"), F.max(F.struct("comp", *rest)).alias("d"),
    ).where("c < d.comp").select("token")
    return kept.join(several, "token")


def in_common(a: str, b: str) -> Column:
    """The most shingles that two nodes can share, from their counts by rarity."""
    return sum(F.least(f"{name}{a}", f"{name}{b}") for name in _HELD)


def _several(rows: DataFrame) -> DataFrame:
    """(token, low, high) of shingles in several components, with the sizes of their nodes."""
    return rows.groupBy("token").agg(
        F.min("comp").alias("c"), F.max("comp").alias("d"),
        F.shiftright(F.min("size"), 32).alias("low"), F.shiftright(F.max("size"), 32).alias("high"),
        F.count("node").alias("nodes"),
    ).where("c < d").select("token", "low", "high", "nodes")


def linked_nodes(
    signed: DataFrame, docs: DataFrame, key: str, text: str, width: int, percent: int,
) -> tuple[DataFrame, DataFrame]:
    """(links, components) between nodes."""
    nodes = signed.where("node IS NOT NULL").groupBy("node").agg(F.min("key").alias("first"))
    shared = _stored(shared_rows(signed).distinct(), "shared")
    first = with_pivots(shared).withColumns({"place1": F.col("at1"), "place2": F.col("at2")}).where(
        (F.col("node1") != F.col("node2")) & possible("1", "2", percent)
        & (F.least("held1", "held2") >= F.least(required(percent=percent), F.lit(MOST_HELD))))
    tried = _stored(counted(first.select(
        F.col("node1").alias("a"), F.col("node2").alias("b")).distinct(), shared, percent
    ).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    links = _stored(verified(tried, nodes, docs, key, text, width, percent), "found")
    comps = _stored(components(links), "comps")
    open_ = open_rows(shared, comps, percent)
    side = lambda s: [F.col("token")] + [
        F.col(x).alias(f"{x}{s}")
        for x in ("node", "n", "at", "least", "comp", "place", "before", *_HELD)]
    across = open_.select(*side("1")).join(open_.select(*side("2")), "token").where(
        (F.col("node1") < F.col("node2")) & (F.col("comp1") != F.col("comp2"))
        & (in_common("1", "2") >= required(percent=percent))
        & possible("1", "2", percent)
        # Where they share one of the shingles just before, the pair has been met there.
        & ~F.arrays_overlap("before1", "before2"))
    met = _stored(
        across.select(F.col("node1").alias("a"), F.col("node2").alias("b")).distinct(), "met")
    more = counted(met, shared, percent).join(tried, ["a", "b"], "left_anti")
    more = verified(
        _stored(more, "pairs"), nodes, docs, key, text, width, percent, doubtful=True)
    links = _stored(links.unionByName(more), "found")
    return links, components(links)


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH,
    percent: int = PERCENT,
) -> DataFrame:
    """(key, n_shingles, node, component, component_id, n_links), a row per row of ``docs``.

    Documents of at least one word link when 100 * intersection >= percent * union of their
    shingle sets; component_id is the least key reachable, the document's own included. node and
    component name the shingle set and the component (of which repeated keys can have several);
    n_links counts the other sets that this one was found to link with. Repeated rows and copies
    share a node; null and empty texts have no node and are their own components; a null key does
    not count as least unless a component has no other. Other columns are left out; an empty table
    gives no rows.
    """
    kind = docs.schema[key].dataType.simpleString()
    named = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    frequent = excess(sketch(named, "_text", width))
    signed = _stored(named.mapInArrow(
        _signer(frequent, width, percent),
        f"key {kind}, n long, node long, least int, prefix array<long>"), "signed")
    links, comps = linked_nodes(signed, named, "_key", "_text", width, percent)
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(
        F.count("*").alias("n_links"))
    first = signed.where("node IS NOT NULL").groupBy("node").agg(F.min("key").alias("first"))
    by_node = first.join(comps, "node", "left").join(degree, "node", "left").withColumn(
        "comp", F.coalesce("comp", "node"))
    least = by_node.groupBy("comp").agg(F.min("first").alias("component_id"))
    placed = by_node.join(least, "comp").select(
        "node", F.col("comp").alias("component"), "component_id", "n_links")
    rows = signed.select("key", "n", "node")
    # Rows without a node stay out of the join, where they would meet in one partition.
    alone = rows.where("node IS NULL").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), "node",
        F.col("node").alias("component"), F.col("key").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    return rows.where("node IS NOT NULL").join(placed, "node").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), "node", "component",
        "component_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    ).unionByName(alone)


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, one of each component: that of the least key, all columns kept.

    Of rows that tie in key and shingles the first in the order of all columns stays. Texts
    without words stay, all of them. Null keys come last. Names that begin with ``_jaccard_`` are
    taken.
    """
    def named(texts):
        for part in texts:
            yield pd.Series([node_of(shingle_set(t)) for t in part], dtype="Int64")

    named.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    node = F.pandas_udf(named, "long")
    kept = near_duplicates(docs, key, text).where("node IS NOT NULL").groupBy("component").agg(
        F.min(F.struct(
            F.col(key).isNull().alias("none"), F.col(key).alias("key"), "node")).alias("row")
    ).select(F.col("row.key").alias("_jaccard_key"), F.col("row.node").alias("_jaccard_kept"))
    worded = F.coalesce(F.col(text).rlike(WORD), F.lit(False))
    # No text with words is without a name. A column that could be null would be filtered for the
    # join, and each text named twice, in two Python workers a task.
    rows = docs.where(worded).withColumn(
        "_jaccard_node", F.coalesce(node(F.col(text)), F.lit(0).cast("long"))).join(
        kept, F.col(key).eqNullSafe(F.col("_jaccard_key"))
        & (F.col("_jaccard_node") == F.col("_jaccard_kept")), "left_semi")
    order = Window.partitionBy("_jaccard_node", key).orderBy(*docs.columns)
    first = rows.withColumn("_jaccard_place", F.row_number().over(order)).where(
        "_jaccard_place = 1")
    return first.select(*docs.columns).unionByName(docs.where(~worded))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle counts and near-duplicate components of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id")


OP5_SQL = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_both
    FROM s x JOIN s y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
link AS (
    SELECT a, b FROM common JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
    WHERE 100 * n_both >= 75 * (p.n + q.n - n_both)),
sym AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(a, b) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT reach.a, sym.b FROM reach JOIN sym ON reach.b = sym.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) r USING (doc_id)
"""
