"""SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import connected_components, small_batches, stored, unused

BLOCK = 1 << 16  # shingles hashed at a time, so that a huge text needs little memory
SLICES, SLICE = 6, 10  # short SimHashes of a set of shingles, and their bits
APART = 24  # of 64 bits: sets that share 0.8 of their shingles differ in 10, and in more than 24 once in some millions
WITHIN = 2  # bits of a short SimHash in which nodes that meet may differ
ALL_PAIRS = 16  # nodes that share a shingle and are compared each with each at once; of more, what their heads leave open follows
IN_BLOCK = 256  # nodes of a larger place that are compared in one group, with as many others
COUNTERS = 1 << 18  # counts of shingles by their hash, by which rare ones come first
LOAD = 8  # bits of a set's bitmap for each shingle, at least
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)  # byte value -> its bits, high first


def _shingles(text: str | None, size: int) -> Iterator[np.ndarray]:
    """Hashes of a text's word shingles, BLOCK at a time; a text of fewer words is one shingle."""
    words = (text or "").encode().lower().split()
    if not words:
        return
    size = min(size, len(words))
    line = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - size + 1
    first, last = starts[:n].tolist(), ends[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    for k in range(0, n, BLOCK):
        yield np.fromiter((digest(line[i:j], 42) for i, j in zip(first[k : k + BLOCK], last[k : k + BLOCK])), np.uint64)


def _majority(blocks: Iterable[np.ndarray]) -> int:
    """The SimHash of hashes, as a signed number; 0 for none."""
    ones, n = np.zeros((8, 8), np.int64), 0
    for hashes in blocks:
        n += len(hashes)
        lanes = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
        if len(lanes) < 64:
            ones += np.unpackbits(lanes, axis=1).sum(axis=0, dtype=np.int64).reshape(8, 8)
        else:
            for lane in range(8):
                ones[lane] += np.bincount(lanes[:, lane], minlength=256) @ _BITS
    bits = (2 * ones.ravel() > n).astype(np.uint8)
    return int(np.packbits(bits).view(">i8")[0])


def text_simhash(text: str | None, size: int = 3) -> int:
    """The 64-bit SimHash of a text's word shingles, as a signed number; 0 for a text without words or null."""
    return _majority(_shingles(text, size))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Hashes of the distinct word shingles, sorted."""
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *_shingles(text, size)]))


def set_digest(shingles: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).view(np.int64))


_MULTIPLY = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


def least_hashes(shingles: np.ndarray) -> list[int]:
    """For each slice, the shingle that is least under a hash of its own; two sets agree as often as they share shingles."""
    mixed = (shingles ^ (shingles >> np.uint64(29)))[None, :] * _MULTIPLY[:, None]
    return mixed.min(axis=1, initial=np.iinfo(np.uint64).max).view(np.int64).tolist()


def bitmap(shingles: np.ndarray) -> bytes:
    """A power of two of bits, LOAD a shingle or more, in which each shingle sets one: folded in half, that of half the bits.

    Two sets share no more shingles than bits, plus those that fell on a bit of their own set already: a bound, not an
    estimate.
    """
    bits = 1 << max(6, (LOAD * max(len(shingles), 1) - 1).bit_length())
    mixed = (shingles ^ (shingles >> np.uint64(31))) * _MULTIPLY[0]
    out = np.zeros(bits, bool)
    out[((mixed >> np.uint64(16)) % np.uint64(bits)).astype(np.int64)] = True
    return np.packbits(out).tobytes()


def folded(maps: list[bytes], size: int) -> np.ndarray:
    """These bitmaps, of the same number of bytes, as rows of words, folded down to `size` bytes."""
    rows = np.frombuffer(b"".join(maps), np.uint64).reshape(len(maps), -1)
    while rows.shape[1] * 8 > size:
        rows = rows[:, : rows.shape[1] // 2] | rows[:, rows.shape[1] // 2 :]
    return rows


def bounded_pairs(left: pd.DataFrame, right: pd.DataFrame, similarity: float, may: Callable[[int, np.ndarray], np.ndarray] | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """For each row of `left` (size, bits, bitmap) the rows of `right` that may reach the similarity, by number.

    Sizes, the SimHash and `may` (a row of `left`, rows of `right`) decide first; then the bound by bitmaps, which no pair
    that has the similarity misses.
    """
    of = {name: {int(n): g for n, g in side.groupby(side["bitmap"].str.len())} for name, side in (("left", left), ("right", right))}
    for n, a in of["left"].items():
        for m, b in of["right"].items():
            if not n // 2 <= m <= 2 * n:
                continue  # sets of such unlike sizes cannot be similar
            size = min(n, m)
            x, y = folded(a["bitmap"].tolist(), size), folded(b["bitmap"].tolist(), size)
            sizes, prints = b["size"].to_numpy(), b["bits"].to_numpy(np.int64).view(np.uint64)  # bits of signed numbers would be those of their absolute values
            spare_y = sizes - np.bitwise_count(y).sum(axis=1)
            for i, row, own, print_ in zip(a.index, x, a["size"], a["bits"].to_numpy(np.int64).view(np.uint64)):
                need = similarity / (1 + similarity) * (sizes + own) - 1e-6
                some = np.flatnonzero((np.minimum(sizes, own) >= need) & (np.bitwise_count(prints ^ print_) <= APART))
                if may is not None:
                    some = some[may(i, b.index.to_numpy()[some])]
                if len(some):
                    shared = np.bitwise_count(y[some] & row).sum(axis=1) + np.minimum(spare_y[some], own - int(np.bitwise_count(row).sum()))
                    yield i, b.index.to_numpy()[some[shared >= need[some]]]


def ball_links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """Links (a, b) between distinct fingerprints `fp` at `radius` or fewer differing bits, enough to join all that touch.

    Every fingerprint emits itself and all its variants within half the radius. Two fingerprints within the radius
    share a variant. All that share a variant lie within the radius of one another, so a star from the smallest keeps
    them together; a variant meets at most as many distinct fingerprints as half a ball holds (65 for radius 2), however
    many documents carry them. Links are verified and deduplicated.
    """
    if radius != 2:
        raise ValueError("only radius 2 is built: variants within one bit")
    flips = F.array(F.lit(0).cast("long"), *[F.lit((1 << i) - (1 << 64 if i == 63 else 0)) for i in range(64)])
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = prints.repartition(tasks, "fp").select("fp", F.explode(F.transform(flips, lambda m: F.col("fp").bitwiseXOR(m))).alias("variant"))
    met = spread.groupBy("variant").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
    star = met.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a <> b").distinct()
    return star.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def _sketched(size: int):
    @F.pandas_udf("fp long, bits long, size long, marks array<long>")
    def sketch(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            sets = [shingle_set(t, size) for t in texts]
            yield pd.DataFrame({"fp": [set_digest(s) for s in sets], "bits": [_majority([s]) for s in sets], "size": [len(s) for s in sets], "marks": [least_hashes(s) for s in sets]})

    return sketch


def slotted(nodes: DataFrame) -> DataFrame:
    """(fp, bits, size, place, n, own): SLICES rows a node of `nodes` (fp, bits, size, marks); stored.

    The 64 bits are cut into short SimHashes, `own`, and each goes with a shingle of its own, the least under one hash; the
    n nodes that have it for that slice are a place. Shingles that one node alone has are left out.
    """
    slots = nodes.select("fp", "bits", "size", F.posexplode("marks").alias("slot", "mark"))
    shared = slots.groupBy("slot", "mark").agg(F.count("*").alias("n")).filter("n > 1")
    own = F.expr(f"shiftrightunsigned(bits, slot * {SLICE}) & {(1 << SLICE) - 1}").cast("int")
    return stored(slots.join(shared, ["slot", "mark"]).select("fp", "bits", "size", F.xxhash64("slot", "mark").alias("place"), "n", own.alias("own")), "simhash-slots")


def rare_first(shingles: np.ndarray, counts: np.ndarray, similarity: float) -> np.ndarray:
    """The rarest of a set's shingles, by `counts` and then by hash: so many that two sets with the similarity share one.

    A set shares `similarity` of its shingles with any such set. If all but one less than that come last in an order that
    holds for all sets, one that is shared is left among the first of both. Wrong counts cost time only.
    """
    keep = len(shingles) - int(np.ceil(similarity * len(shingles) - 1e-6)) + 1
    return shingles[np.lexsort((shingles, counts[(shingles % np.uint64(COUNTERS)).astype(np.int64)]))[:keep]]


def partnered(slots: DataFrame, texts: DataFrame, nodes: DataFrame, size: int, similarity: float) -> DataFrame:
    """`slots` without those nodes of places of more than ALL_PAIRS that can be similar to no other node of such a place; stored.

    Texts that have a common passage, and nothing else, meet in large places. They are told by their rarest shingles: a node
    none of whose `rare_first` shingles another has is similar to none. Rows grow with the sets, not with the places.
    """
    large = slots.filter(F.col("n") > ALL_PAIRS)
    crowd = texts_of(large.select("fp"), texts, nodes)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for t in batch["text"]:
                sums[(shingle_set(t, size) % np.uint64(COUNTERS)).astype(np.int64)] += 1
        at = np.flatnonzero(sums)
        yield pd.DataFrame({"at": at, "n": sums[at]})

    found = crowd.select("text").mapInPandas(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).filter("n > 1").toPandas()  # COUNTERS rows at most
    counts = np.ones(COUNTERS, np.int32)
    counts[found["at"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)

    @F.pandas_udf("array<long>")
    def rarest(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([rare_first(shingle_set(t, size), counts, similarity).view(np.int64) for t in batch], dtype=object)

    keys = stored(crowd.select("fp", rarest("text").alias("keys")), "simhash-rare").select("fp", F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).filter("low <> high").select("key")
    able = stored(keys.join(shared, "key", "left_semi").select("fp").distinct(), "simhash-able")
    large = large.drop("n").join(able, "fp", "left_semi")
    large = large.join(large.groupBy("place").agg(F.count("*").alias("n")).filter("n > 1"), "place").select(*slots.columns)
    return stored(slots.filter(F.col("n") <= ALL_PAIRS).unionByName(large), "simhash-slots")


def meetings(slots: DataFrame) -> DataFrame:
    """(place, n, node) of `slots`: two nodes of a place meet if their short SimHashes differ in WITHIN or fewer bits.

    Places are counted, not gathered, as a large group of near copies is in one.
    """
    return slots.select("place", "n", F.struct("fp", "bits", "size", "own").alias("node"))


def _near(a: Column, b: Column, similarity: float) -> Column:
    """Whether two nodes of a place meet, and may reach the similarity by their bits and by the sizes of their sets."""
    alike = F.least(a["size"], b["size"]) >= F.greatest(a["size"], b["size"]) * (similarity - 1e-9)
    return alike & (F.bit_count(a["bits"].bitwiseXOR(b["bits"])) <= APART) & (F.bit_count(a["own"].bitwiseXOR(b["own"])) <= WITHIN)


def _pairs_in(nodes: str, good: Callable[[Column, Column], Column]) -> Column:
    """The pairs (a, b) of an array of nodes that are `good`; others are never made."""
    of = lambda a: F.transform(F.filter(nodes, lambda b: good(a, b)), lambda b: F.struct(a["fp"].alias("a"), b["fp"].alias("b")))
    return F.flatten(F.transform(nodes, of))


def candidates(met: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of nodes that may be similar: in places of up to ALL_PAIRS all, in larger ones those of two heads only.

    Heads are the smallest node and one that differs from place to place: a large group of near copies is linked by pairs
    that grow with its size. What heads leave open is for `central` and `open_pairs`.
    """
    few = met.filter(F.col("n") <= ALL_PAIRS).groupBy("place").agg(F.collect_list("node").alias("nodes"))
    few = few.select(F.explode(_pairs_in("nodes", lambda a, b: (a["fp"] < b["fp"]) & _near(a, b, similarity))).alias("pair")).select("pair.*")
    many = met.filter(F.col("n") > ALL_PAIRS)
    heads = many.groupBy("place").agg(F.min("node").alias("least"), F.min(F.struct(F.xxhash64("place", "node.fp").alias("rank"), "node")).alias("other"))
    many = many.join(heads.select("place", F.explode(F.array("least", "other.node")).alias("head")), "place")
    a, b = F.col("head"), F.col("node")
    many = many.filter((a["fp"] != b["fp"]) & _near(a, b, similarity))
    return few.unionByName(many.select(F.least("head.fp", "node.fp").alias("a"), F.greatest("head.fp", "node.fp").alias("b"))).distinct()


def texts_of(wanted: DataFrame, texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """(fp, text) of the nodes `wanted` (fp), from one row each (`held`, a row of `texts`); stored, else a function of the
    text would run on all texts before the join."""
    rows = nodes.join(wanted.distinct(), "fp").select("fp", F.col("held").alias("row"))
    return stored(texts.select("row", "text").join(rows, "row").select("fp", "text"), "simhash-texts")


def opened(large: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows of `large` (place, fp, ...) with `root`, of those places whose nodes lie in different components by `roots`."""
    rooted = large.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    open_ = rooted.groupBy("place").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("place")
    return rooted.join(open_, "place")


def large_places(slots: DataFrame, roots: DataFrame) -> DataFrame:
    """(place, n, fp, bits, size, own, root): nodes of the places of more than ALL_PAIRS that lie in different components by
    `roots`; stored."""
    return stored(opened(slots.filter(F.col("n") > ALL_PAIRS), roots), "simhash-open")


def with_bitmaps(large: DataFrame, texts: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """`large` with each node's bitmap; stored. Only nodes that need one get it, as it is cut from the text."""

    @F.pandas_udf("binary")
    def mapped(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([bitmap(shingle_set(t, size)) for t in batch], dtype=object)

    maps = stored(texts_of(large.select("fp"), texts, nodes).select("fp", mapped("text").alias("bitmap")), "simhash-maps")
    return stored(large.join(maps, "fp"), "simhash-mapped")


def central(large: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of each place's central node with those of other components that may be similar to it.

    Central is the node whose SimHash is nearest to the majority of its place: of near copies of one text mostly that text,
    which links most of them by pairs that grow with the place's size.
    """
    ones = [F.sum(F.shiftrightunsigned("bits", i).bitwiseAND(F.lit(1))) for i in range(64)]
    middles = large.groupBy("place").agg(F.array(*[(2 * x > F.count("*")).cast("long") for x in ones]).alias("ones"))
    middles = middles.select("place", F.aggregate(F.reverse("ones"), F.lit(0).cast("long"), lambda x, bit: F.shiftleft(x, 1).bitwiseOR(bit)).alias("middle"))
    node = F.struct("fp", "bits", "size", "own", "root").alias("node")
    ranked = large.join(middles, "place").select("place", node, F.bit_count(F.col("bits").bitwiseXOR(F.col("middle"))).alias("off"))
    heads = ranked.groupBy("place").agg(F.min(F.struct("off", "node")).alias("best")).select("place", F.col("best.node").alias("head"))
    a, b = F.col("head"), F.col("node")
    met = ranked.join(heads, "place").filter((a["root"] != b["root"]) & _near(a, b, similarity))
    return met.select(F.least("head.fp", "node.fp").alias("a"), F.greatest("head.fp", "node.fp").alias("b")).distinct()


def open_pairs(large: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of `large` (with bitmaps) that may be similar, and lie in different components.

    Pairs within a component change nothing. Nodes of a place are dealt to blocks of some IN_BLOCK, and each two blocks are
    compared in a group of their own, so that no task holds a place. What a bound on the shared shingles rules out is left
    out, and nothing else.
    """
    blocks = F.ceil(F.col("n") / IN_BLOCK)
    dealt = large.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("fp", "place"), "blocks"))
    dealt = dealt.withColumn("to", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    cells = dealt.select("place", F.least("block", "to").alias("i"), F.greatest("block", "to").alias("j"), "block", "fp", "bits", "size", "own", "root", "bitmap")

    def compare(nodes: pd.DataFrame) -> pd.DataFrame:
        i, j = int(nodes["i"].iloc[0]), int(nodes["j"].iloc[0])
        left, right = nodes[nodes["block"] == i], nodes[nodes["block"] == j]
        fp, root, own, out = nodes["fp"].to_numpy(), nodes["root"].to_numpy(), nodes["own"].to_numpy(), []
        may = lambda a, of: (root[of] != root[a]) & (np.bitwise_count(own[of] ^ own[a]) <= WITHIN)
        for a, found in bounded_pairs(left, right, similarity, may):
            out += [(min(fp[a], fp[b]), max(fp[a], fp[b])) for b in found.tolist()]
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return cells.groupBy("place", "i", "j").applyInPandas(compare, "a long, b long").distinct()


def verified(pairs: DataFrame, texts: DataFrame, nodes: DataFrame, size: int, similarity: float) -> DataFrame:
    """Those `pairs` (a, b) of nodes whose sets of shingles have a Jaccard similarity of `similarity` or more; stored.

    Sets are cut again from texts, for nodes in pairs only.
    """

    @F.pandas_udf("binary")
    def whole(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([shingle_set(t, size).tobytes() for t in batch], dtype=object)

    @F.pandas_udf(T.DoubleType())
    def jaccard(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(left, right):
            a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            both = len(np.intersect1d(a, b, assume_unique=True))
            out.append(both / max(len(a) + len(b) - both, 1))
        return pd.Series(out, dtype="float64")

    picked = texts_of(pairs.select(F.col("a").alias("fp")).union(pairs.select("b")), texts, nodes)
    sets = stored(picked.select("fp", whole("text").alias("shingles")), "simhash-sets")
    full = pairs.join(sets.withColumnsRenamed({"fp": "a", "shingles": "of_a"}), "a").join(sets.withColumnsRenamed({"fp": "b", "shingles": "of_b"}), "b")
    return stored(full.filter(jaccard("of_a", "of_b") >= similarity - 1e-12).select("a", "b"), "simhash-links")


def similar_links(texts: DataFrame, nodes: DataFrame, size: int, similarity: float) -> DataFrame:
    """Links (a, b) of `nodes` that join all that meet and have a Jaccard similarity of `similarity` or more.

    Places of more than ALL_PAIRS nodes are compared by two heads, those that this leaves in several components by their
    central node, and those that are still not joined by all pairs of nodes in different components; so of all that meet,
    in whatever number, no pair is left out but by its component, its sizes and its SimHash.
    """
    slots = partnered(slotted(nodes), texts, nodes, size, similarity)
    pairs = stored(candidates(meetings(slots), similarity), "simhash-pairs")
    links = verified(pairs, texts, nodes, size, similarity)
    large = large_places(slots, connected_components(links))
    for further in (central, open_pairs):
        if large.isEmpty():
            break
        if further is open_pairs:
            large = with_bitmaps(large, texts, nodes, size)
        new = stored(further(large, similarity).join(pairs, ["a", "b"], "left_anti"), f"simhash-{further.__name__}")
        if not new.isEmpty():
            pairs, links = pairs.unionByName(new), links.unionByName(verified(new, texts, nodes, size, similarity))
        if further is central:
            large = stored(opened(large.drop("root"), connected_components(links)), "simhash-open")
    return links


def _classes(texts: DataFrame, size: int, similarity: float | None) -> DataFrame:
    """(row, doc_id, fp, root, component_id) of rows (row, doc_id, text); with a similarity, `texts` is stored."""
    small_batches(texts.sparkSession)
    if similarity is None:

        @F.pandas_udf(T.LongType())
        def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                yield pd.Series([text_simhash(t, size) for t in batch], dtype="int64")

        rows = stored(texts.select("row", "doc_id", prints("text").alias("fp")), "simhash")
        nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-nodes")
        links = ball_links(nodes.select("fp"))
    else:
        rows = stored(texts.select("row", "doc_id", _sketched(size)("text").alias("s")).select("row", "doc_id", "s.*"), "simhash")
        nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id"), F.min("row").alias("held"), F.first("bits").alias("bits"), F.first("size").alias("size"), F.first("marks").alias("marks")), "simhash-nodes")
        links = similar_links(texts, nodes, size, similarity)
    roots = connected_components(links)
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_print = stored(rooted.join(named, "root").select("fp", "root", "component_id"), "simhash-classes")
    return rows.select("row", "doc_id", "fp").join(of_print, "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, similarity: float | None = None) -> DataFrame:
    """(doc_id, fp, root, component_id) for every row: documents that link, directly or by others.

    Without `similarity`, documents link whose SimHashes `fp` differ in two or fewer bits. With it, `fp` stands for the
    set of a text's shingles of `size` words, and documents link whose sets have that Jaccard similarity: short SimHashes
    propose pairs, and the sets themselves decide.

    Null and empty texts are alike and link like any other. Shingles of very long texts are hashed a block at a time. Rows
    with equal fingerprints are one node, so a large group of copies adds no links. component_id is the smallest doc_id
    reachable; a null doc_id is never the smallest, and a component of null ids only has a null id. Repeated rows stay,
    each with its component. An empty table gives an empty result; other columns of `docs` are not read.
    """
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return _classes(texts if similarity is None else stored(texts, "simhash-rows"), size, similarity).drop("row")


def keep_one(docs: DataFrame, size: int = 3, similarity: float | None = None) -> DataFrame:
    """The rows (all columns) without near-duplicates: of each component one row with the smallest doc_id stays.

    Of several rows with that doc_id, that with the smallest fingerprint stays, and of equal ones the first as read. A
    component whose ids are all null keeps one row. `size` and `similarity` as in near_duplicates. Rows are numbered and
    stored first, so that what stays is decided on narrow rows and no task gathers the texts of an id or of a group.
    """
    name = unused("__row", docs)
    kept = stored(docs.withColumn(name, F.monotonically_increasing_id()), "simhash-rows")
    classes = _classes(kept.select(F.col(name).alias("row"), "doc_id", "text"), size, similarity)
    best = classes.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp", "row")).alias("best"))
    best = stored(best.select(F.col("best.row").alias(name)), "simhash-best")
    gone = stored(classes.select(F.col("row").alias(name)).join(best, name, "left_anti"), "simhash-gone")
    return kept.join(gone, name, "left_anti").select(*docs.columns)
