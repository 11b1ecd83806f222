"""SimHash near-dedup by pigeonhole blocks.

A fingerprint has 64 bits over the XXH64 hashes of word shingles, or more words of 64 bits. It is cut into blocks;
fingerprints that are close agree on some of them, and some blocks together are a join key. With at least
`distance + agree` blocks every pair within the distance shares a key for certain. Within a key only links
that connect are kept (a breadth-first search over the fingerprints not reached yet), never all pairs of a
group; keys with many fingerprints are searched tile by tile. Alternating star contraction joins the links
to components.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from landweave.operators.regions import connected

from .common import small_enough, text_of, written
from .encoding import release

#: Fingerprints of one key that a tile's side may hold; keys with more are cut into tiles.
TILE = 8192

#: Shingles (and a few for each row) of one group that a tile's side may hold.
VOLUME = 1 << 20

#: Fingerprints that a key should hold on average: keys get wider as the table grows.
CROWD = 64

#: The words of a wide fingerprint, its blocks' width in bits, and how many keys of four blocks each it has.
WIDE, BLOCK_BITS, KEYS = ("fp", "fp2"), 4, 128


def _hashes(text: str, width: int, seed: int) -> Iterator[np.ndarray]:
    """The hashes of a text's shingles in order: A-Z lower-cased, words cut at ASCII white space."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        yield np.array([digest(joined, seed)], "<u8")
        return
    total = len(words) - width + 1
    for at in range(0, total, 65536):  # a long text's hashes in parts
        upto = min(at + 65536, total)
        spans = zip(starts[at:upto].tolist(), ends[at + width - 1 : upto + width - 1].tolist(), strict=True)
        yield np.array([digest(joined[a:b], seed) for a, b in spans], "<u8")


def _majority(parts: Iterable[np.ndarray]) -> int:
    counts, total = np.zeros(64, np.int64), 0
    for h in parts:
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        total += len(h)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def fingerprint(text: str, width: int = 4, seed: int = 42) -> int:
    """The SimHash of a text: A-Z lower-cased, words cut at ASCII white space, every shingle counted as often as it occurs."""
    return _majority(_hashes(text, width, seed))


def _fingerprints(width: int, seed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            prints = np.array([fingerprint(x.as_py(), width, seed) for x in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "fp": prints.view(np.int64)})

    return run


def fingerprints(docs: DataFrame, width: int = 4, seed: int = 42) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every row; a null text is empty, and its fingerprint is zero."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(_fingerprints(width, seed), "doc_id long, fp long")


def block_keys(words: Sequence[Column], cuts: Sequence[tuple[int, int, int]], chosen: Sequence[Sequence[int]]) -> Column:
    """array<long>: for each choice of blocks its number and those blocks' bits. A block is (word, first bit, end)."""
    parts = [F.shiftrightunsigned(words[w], a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for w, a, b in cuts]
    wide = F.array(*[F.lit(b - a) for _, a, b in cuts])
    picks = F.array(*[F.array(*map(F.lit, c)) for c in chosen])

    def key(bits: Column, pick: Column, number: Column) -> Column:
        start = F.shiftleft(number.cast("long"), 48)
        joined = F.aggregate(pick, F.lit(0).cast("long"), lambda k, i: F.call_function("shiftleft", k, F.get(wide, i)).bitwiseOR(F.get(bits, i)))
        return start.bitwiseOR(joined)

    # The outer transform has one element: it works the blocks out once for all keys.
    return F.flatten(F.transform(F.array(F.array(*parts)), lambda bits: F.transform(picks, lambda pick, number: key(bits, pick, number))))


def certain_keys(count: int, distance: int, fp: Column) -> Column:
    """Keys of a 64-bit fingerprint of which all within `distance` share one: `agree` of distance + agree blocks.

    More blocks make wider keys; `agree` is the least at which a key holds about CROWD of `count` fingerprints. Results don't depend on it.
    """
    agree = next((a for a in range(2, 6) if 64 * a / (distance + a) >= math.log2(max(count, 1) / CROWD + 1)), 6)
    ends = [round(64 * i / (distance + agree)) for i in range(distance + agree + 1)]
    cuts = [(0, a, b) for a, b in zip(ends, ends[1:], strict=False)]
    return block_keys([fp], cuts, list(combinations(range(len(cuts)), agree)))


def likely_keys(count: int, words: Sequence[Column], keys: int = KEYS, seed: int = 1) -> Column:
    """Keys of a wide fingerprint of which close ones share one with high probability: fixed choices among its blocks of four bits.

    A key has four blocks, or more where the `count` of fingerprints asks for wider keys; there are more keys then, as many as keep the
    probability at a shingle similarity of 0.8 (two such texts differ in 15 of 100 bits) the same or better.
    """
    bits = max(16, math.ceil(math.log2(max(count, 1) / CROWD + 1)))
    agree = -(-bits // BLOCK_BITS)
    total = math.ceil(keys / (0.8485**BLOCK_BITS) ** (agree - 4))
    cuts = [(w, a, a + BLOCK_BITS) for w in range(len(words)) for a in range(0, 64, BLOCK_BITS)]
    random, chosen = np.random.default_rng(seed), set()
    while len(chosen) < total:
        chosen.add(tuple(sorted(random.choice(len(cuts), agree, replace=False).tolist())))
    return block_keys(words, cuts, sorted(chosen))


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The number of bits in which fingerprints (rows of words) differ."""
    return np.bitwise_count(a ^ b).sum(1, dtype=np.int64)


def _links_of_run(fp: np.ndarray, group: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links (places) that connect all fingerprints of a run that are connected: a tree for each component.

    Those of one group (but 0) are connected already: they need no link, and one link to another group is enough. The first tree grows
    from the fingerprint nearest to the run's majority bits: where copies differ from one text, from that text.
    """
    bits = np.unpackbits(np.ascontiguousarray(fp).view(np.uint8), axis=1).sum(0, dtype=np.int64)
    central = np.argmin(_apart(fp, np.packbits(2 * bits > len(fp)).view(np.uint64)))
    left = np.concatenate([[central], np.delete(np.arange(len(fp)), central)])

    def joined(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What is found with all left of its groups, and the rest."""
        own = np.isin(left, found) | (np.isin(group[left], group[found]) & (group[left] > 0))
        return left[own], left[~own]

    while len(left) > 1:
        frontier, left = joined(left[:1])
        while len(frontier) and len(left):
            at, frontier = frontier[0], frontier[1:]
            near = _apart(fp[left], fp[at]) <= distance
            if near.any():
                found = left[near]
                _, first = np.unique(np.where(group[found] > 0, group[found], -1 - found), return_index=True)
                yield np.full(len(first), at), found[first]
                new, left = joined(found)
                frontier = np.concatenate([frontier, new])


def _links_of_runs(key: np.ndarray, fp: np.ndarray, group: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the runs of equal keys: short runs all at once, by shifts; long ones each by a search. Both connect the same."""
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sizes = np.diff(np.concatenate([first, [len(key)]]))
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    short = 8
    size_of = np.repeat(sizes, sizes)
    for shift in range(1, short):
        here = np.flatnonzero((key[shift:] == key[:-shift]) & (size_of[shift:] <= short)) if len(key) > shift else []
        if not len(here):
            break
        here = here[(group[here] == 0) | (group[here] != group[here + shift])]
        near = here[_apart(fp[here], fp[here + shift]) <= distance]
        a.append(near)
        b.append(near + shift)
    for k in np.flatnonzero(sizes > short):
        own = slice(first[k], first[k] + sizes[k])
        for x, y in _links_of_run(fp[own], group[own], distance):
            a.append(x + first[k])
            b.append(y + first[k])
    return np.concatenate(a), np.concatenate(b)


def _search(distance: int, words: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        names = ["key", "tile", "group", *words]
        held = [np.zeros(0, np.int64)] * len(names)

        def links(cols: list[np.ndarray]) -> pa.RecordBatch:
            key, tile, group, *fp = cols
            fps = np.ascontiguousarray(np.stack(fp, axis=1)).view(np.uint64)
            # Runs are of one key and tile; the numbers of the runs stand for both.
            number = np.cumsum(np.concatenate([[0], (key[1:] != key[:-1]) | (tile[1:] != tile[:-1])])) if len(key) else key
            a, b = _links_of_runs(number, fps, group, distance)
            return pa.RecordBatch.from_pydict({"a": _named(fps[a]), "b": _named(fps[b])})

        for batch in batches:
            cols = [np.concatenate([h, batch.column(c).to_numpy(zero_copy_only=False)]) for h, c in zip(held, names, strict=True)]
            if not len(cols[0]):
                continue
            last = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]))
            cut = last[-1] + 1 if len(last) else 0  # the last run may go on in the next batch
            held = [c[cut:] for c in cols]
            yield links([c[:cut] for c in cols])
        yield links(held)

    return run


def _named(fps: np.ndarray) -> pa.Array:
    """Fingerprints as binaries of their words, the highest byte first."""
    raw = np.ascontiguousarray(fps).astype(">u8")
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(8 * fps.shape[1]), len(fps), [None, pa.py_buffer(raw.tobytes())]).cast(pa.binary())


def name_of(*words: Column) -> Column:
    """The binary that names a fingerprint in links."""
    return F.unhex(F.concat(*[F.lpad(F.hex(w), 16, "0") for w in words]))


def near_links(nodes: DataFrame, distance: int, keys: Column, words: Sequence[str] = ("fp",), tile: int = TILE) -> DataFrame:
    """Links (a > b, `name_of` each) between fingerprints that differ in at most `distance` bits and share one of `keys`.

    They connect what all such links would. `nodes` is a written table of the words, one row for each distinct fingerprint, and maybe
    of group: fingerprints of one group (but 0) are connected already.
    """
    # Nodes are few bytes but many keys each: as many tasks as a shuffle has, not as many as their files fill.
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group = F.col("group") if "group" in nodes.columns else F.lit(0).cast("long")
    keyed = nodes.repartition(parts, *words).select(*words, group.alias("group"), F.explode(keys).alias("key"))
    counts = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    hot = small_enough(written(counts.where(F.col("n") > tile).select("key", F.ceil(F.col("n") / tile).cast("int").alias("k")), "hot-keys"))
    part = F.pmod(F.xxhash64(*words), F.col("k")).cast("int")
    tiles = F.when(F.col("k").isNull(), F.array(F.lit(0))).otherwise(_tiles(F.col("k"), part))
    rows = (
        keyed.join(hot, "key", "left")
        .select("key", "group", *words, F.explode(tiles).alias("tile"))
        .repartition("key", "tile")
        .sortWithinPartitions("key", "tile", *words)  # by fingerprint too, so that reruns find the same trees
    )
    links = rows.select("key", "tile", "group", *words).mapInArrow(_search(distance, words), "a binary, b binary")
    return links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def likely_groups(nodes: DataFrame, distance: int, keys: int = KEYS, words: Sequence[str] = WIDE, ahead: int = 8) -> DataFrame:
    """node and root (names) of the fingerprints that hang together by links under the `likely_keys`; `nodes` is a written table of the words.

    The first `ahead` keys connect most of large groups. Under the others a group found by then counts as one, so that a group with many
    members has some links each, not one for each member and key.
    """
    every = likely_keys(nodes.count(), [F.col(w) for w in words], keys)
    first = connected(near_links(nodes, distance, F.slice(every, 1, ahead), words))
    first = written(first, "first-groups")
    numbers = written(first.select(F.col("root").alias("of")).distinct().select("of", (F.monotonically_increasing_id() + 1).alias("group")), "group-numbers")
    members = first.select("node", "root").unionByName(numbers.select(F.col("of").alias("node"), F.col("of").alias("root")))
    members = members.join(numbers, F.col("root") == F.col("of")).select(F.col("node").alias("name"), "group")
    grouped = nodes.withColumn("name", name_of(*map(F.col, words))).join(members, "name", "left")
    grouped = written(grouped.select(*words, F.coalesce("group", F.lit(0).cast("long")).alias("group")), "grouped-nodes")
    rest = near_links(grouped, distance, F.slice(every, ahead + 1, 1 << 20), words)
    return connected(first.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(rest).distinct())


def near_duplicates(docs: DataFrame, width: int = 4, distance: int = 4, seed: int = 42) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (the smallest doc_id reachable by links) of every row.

    Documents whose fingerprints differ in at most `distance` bits are linked. Null, empty and white-space texts have
    fingerprint zero and link like any other. Rows that repeat a doc_id get a row each. A null doc_id comes last: it names a
    component only where there is no other. An empty table gives no rows. Other columns are not read.
    """
    prints = written(fingerprints(docs, width, seed), "fingerprints")
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    links = near_links(nodes.select("fp"), distance, certain_keys(nodes.count(), distance, F.col("fp")))
    roots = connected(links)
    named = nodes.withColumn("node", name_of(F.col("fp"))).join(roots, "node", "left").select("fp", "least", F.coalesce("root", "node").alias("root"))
    named = written(named, "rooted")
    least = named.groupBy(F.col("root").alias("of")).agg(F.min("least").alias("component_id"))
    named = named.join(least, F.col("root") == F.col("of")).select("fp", "component_id")
    # A text with very many copies makes one fingerprint hot; its rows are a few bytes each, and Spark splits such a side.
    return prints.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _set(parts: list[np.ndarray], seed: int) -> np.ndarray:
    """The sorted set of a text's shingle hashes; a text without words has one, of nothing."""
    return np.unique(np.concatenate(parts)) if parts else np.array([xxhash.xxh64_intdigest(b"", seed)], "<u8")


def wide_fingerprint(shingles: np.ndarray) -> np.ndarray:
    """The SimHash words of a set of shingle hashes: the majority of the hashes' own bits, and that of their mixed bits."""
    mixed = (shingles ^ (shingles >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return np.array([_majority(np.split(h, range(65536, len(h), 65536))) for h in (shingles, mixed)], np.uint64)


def _described(width: int, seed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            prints, nodes, sizes = np.zeros((len(batch), len(WIDE)), np.uint64), [], []
            for i, text in enumerate(batch.column("text")):
                shingles = _set(list(_hashes(text.as_py(), width, seed)), seed)
                prints[i] = wide_fingerprint(shingles)
                nodes.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                sizes.append(len(shingles))
            own = {c: batch.column(c) for c in ("doc_id", "own")}
            words = dict(zip(WIDE, prints.view(np.int64).T, strict=True))
            yield pa.RecordBatch.from_pydict({**own, **words, "node": pa.array(nodes, pa.binary()), "size": pa.array(sizes, pa.int64())})

    return run


def _with_sets(width: int, seed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            sets = [_set(list(_hashes(x.as_py(), width, seed)), seed).view(np.int64) for x in batch.column("text")]
            yield pa.RecordBatch.from_pydict(
                {**{c: batch.column(c) for c in ("group", "ways", *WIDE, "node")}, "shingles": pa.array(sets, pa.list_(pa.int64()))}
            )

    return run


def _similar_of_run(fp: np.ndarray, flat: np.ndarray, bounds: np.ndarray, distance: int, least: float) -> Iterator[tuple[int, np.ndarray]]:
    """Links (at, others) that connect all members of a run that are connected by links within `distance` and at `least` or more.

    Every link is verified while it is searched for. Sets of that similarity share one of their rarest shingles: of n, one of the first
    n - ceil(least * n) + 1. These are compared before the whole sets.
    """
    _, token, often = np.unique(flat, return_inverse=True, return_counts=True)
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(len(fp)), sizes)
    token = token[np.lexsort((token, often[token], owner))]
    heads = sizes - np.ceil(least * sizes - 1e-9).astype(np.int64) + 1
    marked = np.zeros(len(often), bool)

    def common(at: int, others: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """How many of the first shingles of each of the others are among the first of this one."""
        own, n = token[bounds[at] : bounds[at] + lengths[at]], lengths[others]
        marked[own] = True
        ends = np.cumsum(n)
        places = np.arange(ends[-1]) + np.repeat(bounds[others] - (ends - n), n)
        out = np.add.reduceat(marked[token[places]], ends - n, dtype=np.int64)
        marked[own] = False
        return out

    left, free = np.arange(len(fp)), np.ones(len(fp), bool)
    while len(left) > 1:
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            at = frontier.pop()
            near = left[_apart(fp[left], fp[at]) <= distance]
            near = near[(sizes[near] >= least * sizes[at]) & (sizes[at] >= least * sizes[near])]
            near = near[common(at, near, heads) > 0] if len(near) else near
            if not len(near):
                continue
            both = common(at, near, sizes)
            found = near[both >= least * (sizes[near] + sizes[at] - both)]
            if len(found):
                yield at, found
                frontier.extend(found.tolist())
                free[found] = False
                left = left[free[left]]


def _search_similar(distance: int, least: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def links(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(held).combine_chunks()
        shingles = whole.column("shingles").combine_chunks()
        sizes = shingles.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        fps = np.ascontiguousarray(np.stack([whole.column(w).to_numpy() for w in WIDE], axis=1)).view(np.uint64)
        found = _similar_of_run(fps, shingles.flatten().to_numpy(), bounds, distance, least)
        node, a, b = whole.column("node").to_pylist(), [], []
        for at, others in found:
            for x in others.tolist():
                a.append(max(node[at], node[x]))
                b.append(min(node[at], node[x]))
        return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        held, last = [], None
        for batch in batches:
            if not len(batch):
                continue
            group, tile = batch.column("group"), batch.column("tile").to_numpy()
            same = pc.equal(group.slice(1), group.slice(0, len(group) - 1)).to_numpy(zero_copy_only=False)
            first = np.flatnonzero(np.concatenate([[True], ~same.astype(bool) | (tile[1:] != tile[:-1])]))
            for x, y in zip(first.tolist(), [*first[1:].tolist(), len(batch)], strict=True):
                now = group[x].as_py(), tile[x]
                if held and now != last:
                    yield links(held)
                    held = []
                held.append(batch.slice(x, y - x))
                last = now
        if held:
            yield links(held)

    return run


def _tiles(ways: Column, part: Column) -> Column:
    """The numbers of the tiles (pairs of parts) that a row of a part goes to, so that every two rows meet in one."""
    return F.transform(F.sequence(F.lit(0), ways - 1), lambda j: F.least(part, j) * ways + F.greatest(part, j))


def similar(prints: DataFrame, docs: DataFrame, groups: DataFrame, width: int, distance: int, least: float, seed: int = 42, volume: int = VOLUME) -> DataFrame:
    """Links (a > b) between nodes of `prints` that connect what all links do: fingerprints within `distance` and sets alike to `least`.

    `groups` has node (a fingerprint's name) and root: links are looked for among all nodes whose fingerprints have one root, whatever
    links within the distance led to it. A group of more than `volume` shingles is searched tile by tile.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "own")).alias("first")
    named = groups.select(F.col("node").alias("name"), F.col("root").alias("group"))
    nodes = (
        prints.groupBy("node").agg(*[F.first(w).alias(w) for w in WIDE], F.first("size").alias("size"), first)
        .withColumn("name", name_of(*map(F.col, WIDE)))
        .join(named, "name", "left")
        .select("node", *WIDE, "size", F.coalesce("group", "name").alias("group"), "first.doc_id", "first.own")
    )
    nodes = written(nodes, "nodes")
    ways = F.ceil(F.sum(F.col("size") + 16) / volume).cast("int").alias("ways")
    many = nodes.groupBy("group").agg(F.count(F.lit(1)).alias("n"), ways).where("n > 1").select("group", "ways")
    firsts = nodes.join(small_enough(written(many, "groups")), "group").select("group", "ways", *WIDE, "node", F.col("doc_id").alias("id"), F.col("own").alias("key"))
    texts = docs.select("doc_id", text_of().alias("text"), _own().alias("own"))
    texts = texts.join(firsts, (F.col("own") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("id"))).select("group", "ways", *WIDE, "node", "text")
    words = ", ".join(f"{w} long" for w in WIDE)
    schema = f"group binary, ways int, {words}, node binary, shingles array<long>"
    sets = written(texts.mapInArrow(_with_sets(width, seed), schema).dropDuplicates(["node"]), "shingles")
    part = F.pmod(F.xxhash64("node"), F.col("ways")).cast("int")
    rows = (
        sets.select("group", *WIDE, "node", "shingles", F.explode(_tiles(F.col("ways"), part)).alias("tile"))
        .repartition("group", "tile")
        .sortWithinPartitions("group", "tile", "node")
    )
    return rows.select("group", "tile", *WIDE, "node", "shingles").mapInArrow(_search_similar(distance, least), "a binary, b binary").distinct()


def _own() -> Column:
    """A digest of the text; null is empty."""
    return F.unhex(F.md5(text_of()))


def drop_near_duplicates(docs: DataFrame, width: int = 5, distance: int = 28, keys: int = KEYS, least: float = 0.8, volume: int = VOLUME) -> DataFrame:
    """The documents' columns, for one row of each group of near duplicates: the one with the smallest doc_id.

    Fingerprints have 128 bits, over a text's set of shingles. A link joins documents whose fingerprints differ in at most `distance`
    bits and whose shingle sets have a Jaccard similarity of `least` or more; documents of equal shingle sets are one. Links are looked
    for among all documents whose fingerprints hang together by links of at most `distance` bits; of two such fingerprints most share one
    of the `keys` (README has the recall against all pairs). Of rows that share the doc_id that stays, the one whose text is first
    in order does. A null doc_id comes last; null texts count as empty.
    """
    rows = docs.select("doc_id", _own().alias("own"), text_of().alias("text"))
    words = ", ".join(f"{w} long" for w in WIDE)
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, own binary, {words}, node binary, size long"
    prints = written(rows.mapInArrow(_described(width, 42), schema), "fingerprints")
    fps = written(prints.select(*WIDE).distinct(), "fingerprint-nodes")
    groups = likely_groups(fps, distance, keys)
    roots = connected(similar(prints, docs, groups, width, distance, least, volume=volume))
    rooted = prints.join(roots, "node", "left").select("doc_id", "own", F.coalesce("root", "node").alias("root"))
    rooted = written(rooted.distinct(), "roots")
    # The smallest doc_id of each group; a null only where there is no other.
    stays = rooted.groupBy("root").agg(F.min("doc_id").alias("id")).withColumnRenamed("root", "of")
    stays = rooted.join(stays, (F.col("root") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("id")))
    stays = stays.select(F.col("root").alias("stay_root"), F.col("id").alias("stay_id"), F.col("own").alias("stay_own"))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"), _own().alias("own"))
    kept = whole.join(stays, (F.col("own") == F.col("stay_own")) & F.col("id").eqNullSafe(F.col("stay_id")))
    turn = F.row_number().over(W.partitionBy("stay_root").orderBy("row.text"))
    return kept.select("row", turn.alias("turn")).where("turn = 1").select(*[F.col(f"row.`{c}`") for c in docs.columns])
