"""Set similarity join on word shingles by PartEnum signatures.

Sets of about the same size (a band) that are similar enough differ in at most `k` elements.  A hash splits the domain of
shingles into more than `k / 2` parts, so in some part both sets differ by one element at most, and each part into PIECES
pieces, so all of these but one hold the same elements of both: a set's signatures are the fingerprints of its elements in
each part less one piece.  A subset without elements, or with only some that very many texts have, would be the signature of
far too many sets, so it is not sent; that both sets hold the same there is known from either one.  For this there are some
spare parts (as many as are to be expected with one, and four deviations more); sets with more such parts than spare
ones sign again by another hash, and those that have them every time send those too.  Sets near the upper end of a band also sign in the
next one.  No link is lost.

Sets that share signatures, directly or in a chain, form a family.  Chance and passages that very many texts have make chains
of sets that are not alike, longer the more texts there are, so a family larger than a block is split: all shingles but
(100 - percent) in a hundred of a set are in each set it links with, so in any order of the shingles the first one that both
have is among so many and one more of either; with the order by how many sets have a shingle these are rare ones.

Families are verified exactly: equal sets once, the rest by products of 0/1 matrices, a family that is still larger than a
block as pairs of blocks in separate tasks.  Tasks hand on a spanning forest of the links they found, not the pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, cut, free_name, from_gaps, from_planes, gaps, joined, mixed, own, planes, released, slices, text_or_empty, texts_of, tidied, tidied_group
from .components import connected

SEPARATORS = b" \t\n\v\f\r"
SIZE, PERCENT = 4, 85
LEAST_SPARED, PIECES, TRIES = 8, 3, 3
BLOCK_SETS, BLOCK_BYTES = 1000, 24 << 20
FILTER_BITS, RUN_BYTES, MOST_COMMON = 1 << 23, 2 << 20, 1 << 18
BUCKET_ELEMENTS, SPARE_BITS = 1 << 21, 6
SIGNED = "bucket int, names binary, docs binary, copies binary"
SHARED = "range int, a binary, b binary"
COUNTED = "range int, nodes binary, kinds binary, counts binary"
DIGEST = "doc_id bigint, n bigint, digest binary"


def bands(longest: int) -> np.ndarray:
    """Lower ends of the size bands, with two ends past `longest`."""
    ends = [1, 2]
    while ends[-2] <= longest:
        ends.append(max(ends[-1] + 1, ends[-1] * 4 // 3))
    return np.array(ends, dtype=np.int64)


def bands_from(band: np.ndarray) -> np.ndarray:
    """The end of each band: the lower end of the next."""
    ends = bands(1)
    while len(ends) <= band.max(initial=0) + 1:
        ends = bands(2 * int(ends[-1]))
    return ends[band + 1]


def parts(upper: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For sets of at most `upper` elements: parts of the domain, how many of these are spare, and whether links are equality.

    Two sets that link differ in at most k = 2 upper (100 - percent) / (100 + percent) elements.
    """
    k = 2 * upper * (100 - percent) // (100 + percent)
    # the smallest set that signs in the band has so many elements in a part less one piece, on average, if one in seven is common
    held = 6 / 7 * 3 * (PIECES - 1) / PIECES * percent * (100 + percent) / (400 * (100 - percent))
    likely = PIECES * np.exp(-held) * (k // 2 + 1)
    spare = np.where(k >= LEAST_SPARED, np.ceil(likely + 4 * np.sqrt(likely)), 0).astype(np.int64)
    return k // 2 + 1 + spare, spare, k == 0


def shingles(words: np.ndarray, size: int = SIZE) -> np.ndarray:
    """The distinct shingles of one text's words; fewer words make one shingle."""
    if not len(words):
        return words
    if len(words) < size:
        return joined([words[i:i + 1] for i in range(len(words))] + [np.array([len(words)], dtype=np.uint64)])
    n = len(words) - size + 1
    return np.unique(joined([words[i:i + n] for i in range(size)]))


def sets_of(texts: list[bytes], words: Words, size: int) -> list[np.ndarray]:
    found, bounds = words.of(texts)
    return [shingles(found[a:z], size) for a, z in zip(bounds[:-1], bounds[1:], strict=True)]


def signatures(sets: list[np.ndarray], percent: int = PERCENT, common: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of non-empty sets and the position of the set each belongs to; `common` elements (sorted) alone make none."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    ends = bands(int(sizes.max(initial=1)))
    home = np.searchsorted(ends, sizes, side="right") - 1
    up = np.flatnonzero(100 * sizes >= percent * ends[home + 1])
    which = np.concatenate([np.arange(len(sets)), up])
    band = np.concatenate([home, home[up] + 1])
    found, owners = [], []
    for attempt in range(TRIES):
        names, owner, weak = signed_once([sets[w] for w in which], band, attempt, attempt == TRIES - 1, percent, common)
        found.append(names)
        owners.append(which[owner])
        which, band = which[weak], band[weak]
        if not len(which):
            break
    return np.concatenate(found), np.concatenate(owners)


def signed_once(sets: list[np.ndarray], band: np.ndarray, attempt: int, last: bool, percent: int, common: np.ndarray | None):
    """Signatures by one hash of the domain: names, the set of each, and the sets with more empty subsets than spare parts."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    count, spare, equal = parts(bands_from(band) - 1, percent)
    first = np.cumsum(count) - count
    elements = np.concatenate([np.zeros(0, dtype=np.uint64), *sets])
    rare = np.ones(len(elements))
    if common is not None and len(common):
        rare = (common[np.minimum(np.searchsorted(common, elements), len(common) - 1)] != elements).astype(np.float64)
    of = np.repeat(np.arange(len(sets)), sizes)
    tag = band.astype(np.uint64) * np.uint64(TRIES) + np.uint64(attempt)
    spread = mixed(elements + tag[of])
    piece = PIECES * first[of] + (((spread >> np.uint64(32)) * (PIECES * count[of]).astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
    total = int(count.sum())
    value = mixed(spread)
    sums = [np.bincount(piece, weights=w, minlength=PIECES * total).astype(np.uint64).reshape(-1, PIECES) for w in (
        (value & np.uint64(0xFFFFFFFF)).astype(np.float64), (value >> np.uint64(32)).astype(np.float64), rare)]
    # what a part holds without each of its pieces, or all of it where only equal sets link
    low, high, held = (np.where(np.repeat(equal, count)[:, None], x.sum(axis=1, keepdims=True), x.sum(axis=1, keepdims=True) - x) for x in sums)
    owner = np.repeat(np.arange(len(sets)), count)
    # without elements, or with common ones only
    empty = held == 0
    weak = np.bincount(owner, weights=empty.any(axis=1), minlength=len(sets)) > spare
    part = (np.arange(total) - first[owner]).astype(np.uint64)
    place = np.repeat(np.arange(PIECES, dtype=np.uint64)[None, :], total, axis=0)
    names = joined([low.ravel(), high.ravel(), (part[:, None] * np.uint64(PIECES) + place).ravel(), np.repeat(tag[owner], PIECES)])
    sent = ((~empty | (weak[owner][:, None] & last)) & ((place == 0) | ~equal[owner][:, None])).ravel()
    return names[sent], np.repeat(owner, PIECES)[sent], np.flatnonzero(weak)


def common_shingles(docs: DataFrame, size: int, most: int = MOST_COMMON) -> np.ndarray:
    """Shingles that several of a sample of the documents have, at most `most` of them, sorted.

    Which they are decides how many signatures are shared by chance, never which links are found.  The sample is every 64th
    document by hash, and about 16,384 in smaller tables.
    """
    rate = min(1.0, max(1 / 64, 16_384 / max(docs.count(), 1)))

    def run(batches):
        words = Words(SEPARATORS)
        for batch in batches:
            for part in slices(batch, "text", RUN_BYTES):
                sets = sets_of(texts_of(part), words, size)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, dtype=np.uint64), *sets]).view(np.int64))], names=["s"])

    with released(docs.sparkSession):
        taken = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(rate * (1 << 20))).select("text")
        found = taken.mapInArrow(tidied(run), "s bigint").groupBy("s").agg(F.count("*").alias("c")).where("c > 2").orderBy(F.desc("c"), "s").limit(most).collect()
    return np.sort(np.array([r.s for r in found], dtype=np.int64).view(np.uint64))


def signed(docs: DataFrame, buckets: int, size: int, percent: int, common: np.ndarray, bits: int = 64) -> DataFrame:
    """The signatures of all documents by bucket, a row for each run of texts: their highest `bits` bits in order, as differences,
    and the documents as distances from the smallest one."""
    drop = np.uint64(64 - bits)
    sent = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches):
        words, common = Words(SEPARATORS), sent.value
        starts = starts_of(buckets)
        for batch in batches:
            for part in slices(batch, "text", RUN_BYTES):
                ids = np.array(part.column("doc_id").to_pylist(), dtype=np.int64)
                seen, kept, sets, copies = {}, [], [], []
                for k, s in enumerate(sets_of(texts_of(part), words, size)):
                    # of equal sets in a run the first one signs; the others link to it
                    if len(s):
                        first = seen.setdefault(s.tobytes(), k)
                        if first == k:
                            kept.append(k)
                            sets.append(s)
                        else:
                            copies += [ids[k], ids[first]]
                if not kept:
                    continue
                names, which = signatures(sets, percent, common)
                order = np.argsort(names)
                names, owners = names[order], ids[kept][which[order]]
                edges = np.append(np.searchsorted(names, starts), len(names))
                rows = [(b, gaps(names[a:z] >> drop), apart(owners[a:z]), b"") for b, (a, z) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if z > a]
                if copies:
                    rows.append((int(ids[kept[0]]) % buckets, b"", b"", np.array(copies, dtype=np.int64).tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), *[pa.binary()] * 3), strict=True)], names=["bucket", "names", "docs", "copies"])
    return docs.mapInArrow(tidied(run), SIGNED)


def starts_of(buckets: int) -> np.ndarray:
    """The smallest 64-bit name of each bucket."""
    return np.array([-(-b * (1 << 64) // buckets) for b in range(buckets)], dtype=np.uint64)


def apart(ids: np.ndarray) -> bytes:
    """Ids as the smallest one and the distances from it."""
    least = ids.min()
    return least.tobytes() + planes((ids - least).view(np.uint64))


def from_apart(data: bytes) -> np.ndarray:
    return from_planes(data[8:], np.int64) + np.frombuffer(data[:8], dtype=np.int64) if data else np.zeros(0, np.int64)


def sharing(ranges: int):
    """Links that connect the documents of a bucket which share signatures: from each to the smallest one it is connected with.

    They leave packed, a row for each hash range of their documents: a document has links in as many buckets as it shares
    signatures in, most of them to the same one.
    """
    def run(table: pa.Table) -> pa.Table:
        names = np.concatenate([from_gaps(x) for x in table.column("names").to_pylist()])
        docs = np.concatenate([from_apart(x) for x in table.column("docs").to_pylist()])
        copies = np.frombuffer(b"".join(table.column("copies").to_pylist()), dtype=np.int64).reshape(-1, 2).T
        order = np.argsort(names, kind="stable")
        names, docs = names[order], docs[order]
        same = np.append(names[1:] == names[:-1], False)
        # a link between neighbours joins all documents of a signature
        a, b = stars(*np.concatenate([np.stack([docs[:-1][same[:-1]], docs[1:][same[:-1]]]), copies], axis=1))
        return by_range(a, ranges, ["a", "b"], (a, apart), (b, apart))
    return run


def by_range(ids: np.ndarray, ranges: int, names: list[str], *columns) -> pa.Table:
    """Columns, each with the function that packs it, as a row for each hash range of `ids`."""
    at = (mixed(ids.view(np.uint64)) % np.uint64(ranges)).astype(np.int64)
    order = np.argsort(at, kind="stable")
    at = at[order]
    cuts = np.flatnonzero(np.diff(at, prepend=-1))
    spans = list(zip(cuts, np.append(cuts, len(at))[1:], strict=True))
    return pa.table([pa.array(at[cuts].astype(np.int32)), *(pa.array([pack(values[order][x:y]) for x, y in spans], pa.binary()) for values, pack in columns)],
                    names=["range", *names])


def merged(table: pa.Table) -> pa.Table:
    """The links that all buckets found for a range of documents, again one from each to the smallest it is connected with."""
    pairs = (np.concatenate([from_apart(x) for x in table.column(c).to_pylist()]) for c in ("a", "b"))
    return pa.table([pa.array(x) for x in stars(*pairs)], names=["a", "b"])


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from each document to the smallest one that links (a, b) connect it with."""
    nodes, places = np.unique(np.stack([a, b]), return_inverse=True)
    a, b = places.reshape(2, -1)
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        lower = label.copy()
        # a node's label and that of its label's node both fall to the least seen
        for end in (a, b):
            np.minimum.at(lower, end, least)
            np.minimum.at(lower, label[end], least)
        lower = lower[lower]
        if (lower == label).all():
            break
        label = lower
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a square matrix of links."""
    left, out = np.ones(len(linked), dtype=bool), []
    for root in range(len(linked)):
        if not left[root]:
            continue
        left[root] = False
        front = [root]
        while front:
            at = front.pop()
            new = np.flatnonzero(linked[at] & left)
            left[new] = False
            out += [(at, int(x)) for x in new]
            front += new.tolist()
    return out


def similar(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which pairs of sets link, exactly: intersections by products of 0/1 matrices over the elements that two sets have."""
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    values, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.cumsum(counts > 1) - 1
    rows = np.repeat(np.arange(len(sets)), sizes.astype(np.int64))
    kept = counts[inverse] > 1
    rows, columns = rows[kept], shared[inverse[kept]]
    common = np.zeros((len(sets), len(sets)), dtype=np.float32)
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    width = 4096
    for at in range(0, int(columns[-1]) + 1 if len(columns) else 0, width):
        a, z = np.searchsorted(columns, [at, at + width])
        x = np.zeros((len(sets), min(width, int(columns[-1]) + 1 - at)), dtype=np.float32)
        x[rows[a:z], columns[a:z] - at] = 1
        common += x @ x.T
    union = sizes[:, None] + sizes[None, :] - common
    return 100.0 * common >= percent * union


def verify(percent: int):
    def run(table: pa.Table) -> pa.Table:
        family = table.column("family").to_numpy()
        docs = table.column("doc_id").to_numpy()
        blobs = table.column("elements").to_pylist()
        a, b = [], []
        order = np.lexsort((docs, family))
        cuts = np.flatnonzero(np.diff(family[order], prepend=family[order][:1] - 1))
        for begin, end in zip(cuts, np.append(cuts[1:], len(order)), strict=True):
            rows = order[begin:end]
            if len(rows) > 1:
                sets = [np.frombuffer(blobs[r], dtype=np.uint64) for r in rows]
                for x, y in forest(similar(sets, percent)):
                    a.append(docs[rows[x]])
                    b.append(docs[rows[y]])
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return run


def marked(docs: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """The rows with a column that is false where the id is surely not in `ids`, by a bitmap of FILTER_BITS bits.

    The bitmap is a table of 4 KB rows with that many bits in all, whatever the input.
    """
    spot = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(FILTER_BITS))
    bucket, bits = free_name(docs, "bucket"), free_name(docs, "bits")
    found = ids.select(spot.alias("spot")).groupBy(F.bitmap_bucket_number("spot").alias(bucket)).agg(F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias(bits))
    at = docs.withColumn(bucket, F.bitmap_bucket_number(spot)).join(F.broadcast(found), bucket, "left")
    bit = F.bitmap_bit_position(spot)
    byte = F.conv(F.hex(F.substring(F.col(bits), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return at.withColumn(name, F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))).drop(bucket, bits)


def likely(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose id may be in `ids`, so that few other texts are shuffled to a join."""
    return marked(docs, ids, "marked").where("marked").drop("marked")


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows whose id is not in `gone` (doc_id); those that a bitmap rules out are not shuffled."""
    mark = free_name(docs, "marked")
    at = marked(docs, gone, mark)
    seen, gone = at.where(mark).drop(mark), gone.select(F.col("doc_id").alias("gone"))
    return at.where(~F.col(mark)).drop(mark).union(seen.join(gone, seen["doc_id"].cast("long") == gone["gone"], "left_anti"))


def digest_of(s: np.ndarray) -> bytes:
    return int(mixed(s + np.uint64(len(s))).sum()).to_bytes(8, "little") + int(joined([s, s >> np.uint64(7)]).sum()).to_bytes(8, "little") if len(s) else b""


def members(docs: DataFrame, families: DataFrame, size: int) -> DataFrame:
    """(doc_id, n, digest, family): how large the shingle sets of the documents in families are, and their digests."""
    def run(batches):
        words = Words(SEPARATORS)
        for batch in batches:
            for part in slices(batch, "text", RUN_BYTES):
                sets = sets_of(texts_of(part), words, size)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([digest_of(s) for s in sets], pa.binary())],
                                                 names=["doc_id", "n", "digest"])
    return likely(docs, families).mapInArrow(tidied(run), DIGEST).where("n > 0").join(families, "doc_id")


def sets_at(batches, size: int):
    """Batches of rows with a text and the digest of the set that is asked for, in runs: the rows whose text has that set, and the sets."""
    words = Words(SEPARATORS)
    for batch in batches:
        for part in slices(batch, "text", RUN_BYTES):
            sets, asked = sets_of(texts_of(part), words, size), part.column("digest").to_pylist()
            kept = [k for k, s in enumerate(sets) if digest_of(s) == asked[k]]
            if kept:
                yield part.take(pa.array(kept)), [sets[k] for k in kept]


def texts_for(docs: DataFrame, wanted: DataFrame, *columns: str) -> DataFrame:
    """Columns of `wanted` with the texts of their documents."""
    return likely(docs, wanted).join(wanted, "doc_id").select(*columns, "digest", "text")


def fetched(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """`wanted` (family, doc_id, blocks, digest) with the elements of each set."""
    def run(batches):
        for part, sets in sets_at(batches, size):
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("family", "doc_id", "blocks", "digest")), pa.array([s.tobytes() for s in sets], pa.binary())],
                                             names=["family", "doc_id", "blocks", "digest", "elements"])
    return texts_for(docs, wanted, "family", "doc_id", "blocks").mapInArrow(tidied(run), "family bigint, doc_id bigint, blocks bigint, digest binary, elements binary")


def dealt(docs: DataFrame, wanted: DataFrame, buckets: int, size: int, bits: int) -> DataFrame:
    """The shingles of `wanted` (node, level, doc_id, digest) by bucket, packed as signatures are, with their nodes and these nodes' levels."""
    drop = np.uint64(64 - bits)

    def run(batches):
        starts = starts_of(buckets)
        for part, sets in sets_at(batches, size):
            names, of = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            order = np.argsort(names)
            names, of = names[order], of[order]
            nodes, levels = (part.column(c).to_numpy()[of] for c in ("node", "level"))
            edges = np.append(np.searchsorted(names, starts), len(names))
            rows = [(b, gaps(names[a:z] >> drop), apart(nodes[a:z]), levels[a:z].astype(np.uint8).tobytes()) for b, (a, z) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if z > a]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), *[pa.binary()] * 3), strict=True)], names=["bucket", "names", "nodes", "levels"])
    return texts_for(docs, wanted, "node", "level", "doc_id").mapInArrow(tidied(run), "bucket int, names binary, nodes binary, levels binary")


def ranked(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The shingles of a bucket in order, their nodes, the levels of these, and of each shingle the bits of the number of sets that have it."""
    names = np.concatenate([from_gaps(x) for x in table.column("names").to_pylist()])
    nodes = np.concatenate([from_apart(x) for x in table.column("nodes").to_pylist()])
    levels = np.frombuffer(b"".join(table.column("levels").to_pylist()), dtype=np.uint8)
    order = np.argsort(names, kind="stable")
    names, nodes, levels = names[order], nodes[order], levels[order]
    cuts = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
    times = np.diff(np.append(cuts, len(names)))
    return names, nodes, levels, np.repeat(np.frexp(times.astype(np.float64))[1], times).astype(np.uint8)


def counted(ranges: int):
    """How many shingles of each kind the nodes have in a bucket, a row for each hash range of nodes."""
    def run(table: pa.Table) -> pa.Table:
        _, nodes, _, kinds = ranked(table)
        own, place = np.unique(nodes, return_inverse=True)
        found, counts = np.unique(place * 64 + kinds, return_counts=True)
        nodes = own[found // 64]
        return by_range(nodes, ranges, ["nodes", "kinds", "counts"], (nodes, apart), ((found % 64).astype(np.uint8), np.ndarray.tobytes), (counts.astype(np.uint32), planes))
    return run


def levelled(percent: int):
    """The level of each node: it has enough shingles of kinds up to that one, so that a set it links with has one of them."""
    def run(table: pa.Table) -> pa.Table:
        nodes = np.concatenate([from_apart(x) for x in table.column("nodes").to_pylist()])
        kinds = np.frombuffer(b"".join(table.column("kinds").to_pylist()), dtype=np.uint8)
        counts = np.concatenate([from_planes(x, np.uint32) for x in table.column("counts").to_pylist()]).astype(np.int64)
        order = np.lexsort((kinds, nodes))
        nodes, kinds, counts = nodes[order], kinds[order], counts[order]
        first = np.flatnonzero(np.append(True, nodes[1:] != nodes[:-1]))
        n = np.add.reduceat(counts, first)
        of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(nodes))))
        sums = np.cumsum(counts)
        sums -= (sums[first] - counts[first])[of]
        enough = sums >= (n + (-percent * n) // 100 + 1)[of]
        levels = np.minimum.reduceat(np.where(enough, kinds, np.uint8(255)), first)
        return pa.table([pa.array(nodes[first]), pa.array(levels.astype(np.int32))], names=["node", "level"])
    return run


def rarely(ranges: int):
    """Links that connect the nodes of a bucket which share shingles up to the level of each."""
    def run(table: pa.Table) -> pa.Table:
        names, nodes, levels, kinds = ranked(table)
        kept = kinds <= levels
        names, nodes = names[kept], nodes[kept]
        same = names[1:] == names[:-1]
        a, b = stars(nodes[:-1][same], nodes[1:][same])
        return by_range(a, ranges, ["a", "b"], (a, apart), (b, apart))
    return run


def split(docs: DataFrame, large: DataFrame, size: int, percent: int) -> DataFrame:
    """`large` (doc_id, digest, n), a row for each set, with families such that sets which link are in one; sets that link with none are left out.

    Names of shingles are cut to so many bits that one in 64 meets another one by chance: it then counts as less rare than it is.
    """
    # a document may have several rows, so the sets get numbers of their own
    large = cut(large.select("doc_id", "digest", "n").withColumn("node", F.monotonically_increasing_id()), "large")
    volume = large.agg(F.sum("n")).first()[0] or 0
    if not volume:
        return large.select(F.col("node").alias("family"), "doc_id", "digest", "n")
    buckets, bits = max(24, volume // BUCKET_ELEMENTS), min(64, int(volume).bit_length() + SPARE_BITS)
    ranges = 24 * math.ceil(math.sqrt(buckets / 24))
    levels = cut(dealt(docs, large.withColumn("level", F.lit(0)), buckets, size, bits).groupBy("bucket").applyInArrow(tidied_group(counted(ranges)), COUNTED)
                 .groupBy("range").applyInArrow(tidied_group(levelled(percent)), "node bigint, level int"), "levels")
    links = (dealt(docs, large.join(levels, "node"), buckets, size, bits).groupBy("bucket").applyInArrow(tidied_group(rarely(ranges)), SHARED)
             .groupBy("range").applyInArrow(tidied_group(merged), "a bigint, b bigint"))
    found = connected(links).select("node", F.col("component").alias("family"))
    return cut(large.join(found, "node").select("family", "doc_id", "digest", "n"), "split")


def weighed(sets: DataFrame) -> DataFrame:
    """`sets` (family, doc_id, digest, n) of families with more than one set, and in how many blocks each family is verified."""
    weight = sets.groupBy("family").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK_SETS, F.sum("n") * 8 / BLOCK_BYTES)).alias("blocks"), F.count("*").alias("sets"))
    return sets.join(weight.where("sets > 1").select("family", "blocks"), "family")


def find_links(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) between documents whose shingle sets have a Jaccard similarity of at least `percent` percent.

    The links connect exactly what all links would connect; pairs that are connected anyway may be left out.  Words are runs
    of bytes other than blanks, A-Z lowered.  Null and empty texts link with nothing, rows with a null doc_id neither; rows
    that share a doc_id are one node, linked by what any of them links with.  Other columns are not read.
    """
    spark = docs.sparkSession
    docs = own(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).where("doc_id is not null")
    volume = docs.agg(F.sum(F.octet_length(text_or_empty(F.col("text"))))).first()[0] or 0
    # some millions of signatures to a bucket: a document has at most a link in each bucket
    buckets = max(24, volume * (100 - percent) // (15 << 23))
    # so many bits that a few signatures meet by chance; what they bring together is verified
    bits = min(64, 2 * int(volume).bit_length() - 8 if volume > 1 << 20 else 64)
    # the links of all buckets for a range of documents fit a task, and ranges times buckets stay far fewer than documents
    ranges = 24 * math.ceil(math.sqrt(buckets / 24))
    shares = (signed(docs, buckets, size, percent, common_shingles(docs, size), bits).groupBy("bucket").applyInArrow(tidied_group(sharing(ranges)), SHARED)
              .groupBy("range").applyInArrow(tidied_group(merged), "a bigint, b bigint"))
    families = cut(connected(shares).select(F.col("node").alias("doc_id"), F.col("component").alias("family")), "families")
    digests = cut(members(docs, families, size), "digests")
    # equal sets once: the others link to the smallest document that has the set
    sets = cut(digests.groupBy("family", "digest").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n")), "sets")
    same = digests.select("family", "digest", F.col("doc_id").alias("a")).join(
        sets.select("family", "digest", F.col("doc_id").alias("b")), ["family", "digest"]).where("a <> b").select("a", "b")
    sets, most = cut(weighed(sets), "weighed"), math.inf
    # without the sets that are gone more shingles are rare, so larger families are split as long as that leaves a quarter less to compare
    while 0 < (held := sets.where("blocks > 1").agg(F.sum("blocks")).first()[0] or 0) <= 0.75 * most:
        most, small = held, sets.where("blocks = 1").select("family", "doc_id", "digest", "n", "blocks")
        sets = cut(small.union(weighed(split(docs, sets.where("blocks > 1"), size, percent)).select(*small.columns)), "weighed")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    block = F.pmod(F.xxhash64("digest"), F.col("blocks"))
    pairs = fetched(docs, sets.drop("n"), size).select(
        "family", "doc_id", "elements",
        F.explode(F.when(F.col("blocks") == 1, F.array(F.struct(F.pmod(F.xxhash64("family"), F.lit(4 * tasks)).alias("g"), F.lit(-1).cast("long").alias("i"), F.lit(-1).cast("long").alias("j"))))
                  .otherwise(F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda o: F.struct(
                      F.col("family").alias("g"), F.least(block, o).alias("i"), F.greatest(block, o).alias("j"))))).alias("t"))
    found = pairs.groupBy("t.g", "t.i", "t.j").applyInArrow(tidied_group(verify(percent)), "a bigint, b bigint")
    return cut(same.union(found), "found")


def count_shingles(docs: DataFrame, size: int) -> DataFrame:
    def run(batches):
        words = Words(SEPARATORS)
        for batch in batches:
            for part in slices(batch, "text"):
                n = pa.array([len(s) for s in sets_of(texts_of(part), words, size)], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), n], names=["doc_id", "n_shingles"])
    return own(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(tidied(run), "doc_id bigint, n_shingles bigint")


def groups(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, component_id) of the documents that link with another one; component_id is the smallest doc_id of the group."""
    found = connected(find_links(docs, size, percent))
    return found.select(F.col("node").alias("doc_id"), F.col("component").alias("component_id"))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id, one row per document; a null doc_id has a null component."""
    found = groups(docs).withColumnRenamed("component_id", "c")
    return count_shingles(docs, SIZE).join(found, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("c", "doc_id").alias("component_id"))


def representatives(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """The rows of documents in no group and of the smallest id of each group, same columns.

    Rows are documents each, also where they share an id: of those that are alike one stays, the others all do.  Rows with a null
    doc_id stay.  An empty table gives an empty one.
    """
    again = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1")
    if again.isEmpty():
        return without(docs, cut(groups(docs, size, percent).where("doc_id <> component_id").select("doc_id"), "gone"))
    row = free_name(docs, "row")
    numbered = cut(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    alike = groups(numbered.where("doc_id is not null").select(F.col(row).alias("doc_id"), "text"), size, percent)
    alike = alike.join(numbered.select(F.col(row).alias("r"), F.col("doc_id").cast("long").alias("id")), F.col("doc_id") == F.col("r")).select("r", "id", "component_id")
    first = alike.groupBy("component_id").agg(F.min(F.struct("id", "r"))["r"].alias("first"))
    gone = alike.join(first, "component_id").where("r <> first").select(F.col("r").alias("gone"))
    return numbered.join(gone, F.col(row) == F.col("gone"), "left_anti").drop(row)
