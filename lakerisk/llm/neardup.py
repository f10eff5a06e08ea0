"""Near-duplicate documents by fast similarity sketching.

A document is the set of its distinct word 5-grams, held as 64-bit hashes. Its sketch has ``BINS`` coordinates
and is filled in rounds: in round ``i`` every element is thrown into a hashed bin with the value ``i`` plus a
hashed fraction, and a bin keeps the least value it gets; the second half of the rounds throws all elements
into one bin each, so that every coordinate is filled after ``2 * BINS`` rounds whatever the set. Once all bins
are filled, later rounds cannot change them. Two sketches agree in a coordinate with the sets' similarity.

``BANDS`` bands of the sketch give bucket keys; at the least similarity of 0.75, bands of four coordinates miss
a pair with a probability of about 5 in a million. Documents with equal word sequences are one class and are
sketched as one.

Only links that join components are sought. The members of a bucket are read with their sketches, in blocks of about
``BLOCK``, and two of them are candidates if their sizes allow a link and the sketches agree in ``AGREE`` coordinates:
0.75 of them less four standard deviations, which loses a pair of the least similarity three times in 100,000. First
a block, to which the bucket's hub is added, gives the tree of its best-agreeing candidates: fewer than it has
members, however many pairs there are; these links are confirmed on the full sets by joins. Then only buckets are kept
that still hold several components. Members with a candidate in another component are noted, and their full sets brought
to the bucket, again in blocks; there each member outside the bucket's largest component is compared on the full sets
with its candidates, best first, unless the links found in these blocks already tie the two. A pair is compared in the first
of the bands that it shares alone, and blocks give links that tie components, fewer than they have members. So no bucket
is cut, every candidate is tied or compared, and no join makes pairs of documents; the comparisons in a bucket of edited copies
around the threshold grow with the square of it, the rows that are shuffled do not.

Defined cases: a null or empty text, and one of white space alone, has no shingles and links with nothing;
rows without an id take part but name no component, and are kept only if their whole component has no id;
rows of one id are kept or dropped together when their texts agree; further columns are ignored; an empty
table gives an empty table.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakerisk.llm.common import discard, ready, stored
from lakerisk.llm.graph import components

WORDS = 5
PERCENT = 75
BINS = 128
BANDS = 32
AGREE = 77  # of BINS coordinates
BLOCK = 512
ELEMENTS = 500_000  # of the full sets in a block, about

SKETCH_SCHEMA = "id long, key binary, n long, bands array<long>, marks binary, tags binary"
PAIR_SCHEMA = "a binary, b binary"
SET_SCHEMA = "key binary, shingles array<long>"

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()  # of bytes: A-Z alone, and the six ASCII spaces


def shingles(words: list[bytes]) -> np.ndarray:
    """Sorted distinct hashes of the word 5-grams; of the whole sequence if it is shorter."""
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < WORDS:
        return mix(np.array([xxhash.xxh64_intdigest(b" ".join(words), len(words))], np.uint64))
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = len(words) - WORDS + 1
    total = np.zeros(n, np.uint64)
    for i in range(WORDS):
        total += mix(hashed[i:i + n] ^ _ODD[i])
    return np.unique(mix(total))


def sketch(elements: np.ndarray, bins: int = BINS) -> np.ndarray:
    """The filled coordinates. Values hold the round in the upper 8 bits and the fraction below."""
    bits = np.uint64(bins.bit_length() - 1)  # bins is a power of two, at most 128
    values = np.full(bins, np.iinfo(np.uint64).max, np.uint64)
    done = 0
    while done < 2 * bins and values.max() == np.iinfo(np.uint64).max:
        # rounds that will fill all bins with high probability, taken at once
        rounds = np.arange(done, min(2 * bins, done + max(1, 6 * bins // len(elements))), dtype=np.uint64)
        thrown = mix(elements[None, :] + mix(rounds + _ODD[0])[:, None])
        value = (rounds << np.uint64(56))[:, None] | (thrown & np.uint64(2**56 - 1))
        place = thrown >> (np.uint64(64) - bits)
        late = rounds >= bins
        place[late] = (rounds[late] - np.uint64(bins))[:, None]
        np.minimum.at(values, place.ravel().astype(np.int64), value.ravel())
        done += len(rounds)
    return values


def band_keys(values: np.ndarray, bands: int = BANDS) -> np.ndarray:
    rows = values.reshape(bands, -1)
    total = mix(np.arange(bands, dtype=np.uint64) + _ODD[1])
    for i in range(rows.shape[1]):
        total = mix(total ^ rows[:, i] * _ODD[2])
    return total.view(np.int64)


def _texts(batch) -> list[bytes]:
    return [b"" if x is None else x for x in batch.column("text").cast(pa.binary()).to_pylist()]


def _sketched(batches):
    for batch in batches:
        keys, counts, bands, marks, tags = [], [], [], [], []
        for text in _texts(batch):
            words = words_of(text)
            elements = shingles(words)
            values = sketch(elements) if len(elements) else None
            keys.append(xxhash.xxh128_digest(b" ".join(words)))
            counts.append(len(elements))
            bands.append(None if values is None else band_keys(values))
            marks.append(None if values is None else values.astype(np.uint8).tobytes())  # a random byte of each coordinate
            tags.append(None if values is None else bands[-1].astype(np.uint32).tobytes())  # 32 bits of each band's key
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(keys, pa.binary()), pa.array(counts, pa.int64()), pa.array(bands, pa.list_(pa.int64())),
             pa.array(marks, pa.binary()), pa.array(tags, pa.binary())],
            names=["id", "key", "n", "bands", "marks", "tags"],
        )


def _sets(batches):
    for batch in batches:
        keys, sets = [], []
        for text in _texts(batch):
            words = words_of(text)
            keys.append(xxhash.xxh128_digest(b" ".join(words)))
            sets.append(shingles(words).view(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], names=["key", "shingles"])


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` that link, compared on their full sets."""
    first = sets.select(F.col("key").alias("a"), F.col("shingles").alias("s"))
    second = sets.select(F.col("key").alias("b"), F.col("shingles").alias("t"))
    common = F.size(F.array_intersect("s", "t")).cast("long")
    union = F.size("s") + F.size("t") - common
    return pairs.join(first, "a").join(second, "b").where(100 * common >= PERCENT * union).select("a", "b")


class Members:
    """The members of one or two blocks of a bucket, with the agreement of their sketches."""

    def __init__(self, *blocks: pa.StructArray):
        def column(name):
            return [x for block in blocks for x in block.field(name).to_pylist()]

        self.keys = column("key")
        self.sizes = np.array(column("n"), np.int64)
        self.marks = np.frombuffer(b"".join(column("marks")), np.uint8).reshape(len(self.keys), -1)
        self.tags = np.frombuffer(b"".join(column("tags")), np.uint32).reshape(len(self.keys), -1)
        names = {}
        self.roots = np.array([names.setdefault(r, len(names)) for r in column("root")], np.int64)

    def agreement(self, rows, band: int | None = None) -> np.ndarray:
        """Coordinates in which ``rows`` agree with all members; -1 where the pair is no candidate, or another band's."""
        out = np.empty((len(rows), len(self.keys)), np.int16)
        for at in range(0, len(rows), 32):
            some = rows[at:at + 32]
            same = (self.marks[some][:, None, :] == self.marks[None, :, :]).sum(axis=2, dtype=np.int16)
            n, m = self.sizes[some][:, None], self.sizes[None, :]
            fit = (100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)) & (self.roots[some][:, None] != self.roots[None, :])
            fit &= same >= AGREE
            if band is not None:
                i, j = np.nonzero(fit)
                fit[i, j] = (self.tags[some][i] == self.tags[j]).argmax(axis=1) == band
            out[at:at + 32] = np.where(fit, same, -1)
        return out

    def tree(self) -> list[tuple[int, int]]:
        """The best-agreeing candidates that join all members that candidates can join, one fewer than there are of them."""
        agree = self.agreement(np.arange(len(self.keys)))
        found, outside = [], np.ones(len(self.keys), bool)
        best, source = np.full(len(self.keys), -1, np.int16), np.zeros(len(self.keys), np.int64)
        while outside.any():
            near = int(np.argmax(np.where(outside, best, -2)))
            if best[near] >= 0:
                found.append((int(source[near]), near))
            outside[near] = False
            better = agree[near] > best
            best[better], source[better] = agree[near][better], near
        return found

    def links(self, agree: np.ndarray, rows, others, sets: list[np.ndarray]) -> list[tuple[int, int]]:
        """Links of ``rows`` to candidates among ``others`` that tie components which no link before ties.

        ``agree`` has a line for each of ``rows`` and a column for each of ``others``.
        """
        root = list(range(int(self.roots.max()) + 1))

        def find(x):
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        lengths = np.array([len(x) for x in sets])
        distinct, places = np.unique(np.concatenate(sets), return_inverse=True)
        places = np.split(places, np.cumsum(lengths)[:-1])
        held, found = np.zeros(len(distinct), bool), []
        for i, line in zip(rows, agree):
            good = np.flatnonzero(line >= 0)
            held[places[i]] = True
            for j in others[good[np.argsort(-line[good], kind="stable")]]:
                x, y = find(self.roots[i]), find(self.roots[j])
                if x != y:
                    common = int(np.count_nonzero(held[places[j]]))
                    if 100 * common >= PERCENT * (int(lengths[i]) + int(lengths[j]) - common):
                        root[x] = y
                        found.append((int(i), int(j)))
            held[places[i]] = False
        return found


def _pairs(members: Members, found) -> pa.RecordBatch:
    ends = [sorted((members.keys[i], members.keys[j])) for i, j in found]
    return pa.RecordBatch.from_arrays([pa.array([e[0] for e in ends], pa.binary()), pa.array([e[1] for e in ends], pa.binary())], names=["a", "b"])


def _trees(batches):
    """The tree of each block and its bucket's hub."""
    for batch in batches:
        hubs = batch.column("hub")
        for at in range(batch.num_rows):
            rows, hub = batch.column("members")[at].values, hubs.slice(at, 1)
            inside = hub.field("key")[0].as_py() in rows.field("key").to_pylist()
            if len(rows) > inside:
                members = Members(rows) if inside else Members(rows, hub)
                yield _pairs(members, members.tree())


def _met(batches):
    """Of each row of two blocks: its bucket, the members, their first block's rows that lie outside the bucket's largest
    component, the rows that these may link with, the agreement of both, and the blocks."""
    for batch in batches:
        for at in range(batch.num_rows):
            left, right = batch.column("members")[at].values, batch.column("others")[at].values
            blocks = [left] if right is None else [left, right]
            members = Members(*blocks)
            rows = np.flatnonzero(left.field("outside").to_pylist())
            others = np.arange(0 if right is None else len(left), len(members.keys))
            agree = members.agreement(rows, batch.column("band")[at].as_py())[:, others]
            if (agree >= 0).any():
                yield batch.column("bucket")[at].as_py(), members, rows, others, agree, blocks


def _candidates(batches):
    """The members with a candidate, by bucket."""
    for bucket, members, rows, others, agree, _ in _met(batches):
        able = agree >= 0
        keys = {members.keys[i] for i in [*rows[able.any(axis=1)], *others[able.any(axis=0)]]}
        yield pa.RecordBatch.from_arrays([pa.array([bucket] * len(keys), pa.int64()), pa.array(list(keys), pa.binary())], names=["bucket", "key"])


def _links(batches):
    """Links between blocks, on the full sets."""
    for _, members, rows, others, agree, blocks in _met(batches):
        sets = [x.values.to_numpy() for block in blocks for x in block.field("shingles")]
        found = members.links(agree, rows, others, sets)
        if found:
            yield _pairs(members, found)


def in_blocks(members: DataFrame, *columns: str, weight: Column | None = None) -> DataFrame:
    """``bucket, band, part, members``: the bucket's rows in parts of about ``BLOCK``, of a total weight of about 1."""
    share = F.lit(1 / BLOCK) if weight is None else F.greatest(F.lit(1 / BLOCK), weight)
    sizes = members.groupBy("bucket").agg(F.sum(share).alias("size"))
    part = F.pmod(F.xxhash64("key"), F.ceil("size")).cast("int")
    held = F.collect_list(F.struct("key", "n", "marks", "tags", "root", *columns))
    return members.join(sizes, "bucket").groupBy("bucket", "band", part.alias("part")).agg(held.alias("members"))


def first_pairs(members: DataFrame) -> DataFrame:
    """Candidates that join each block's members with each other and with the bucket's most central one: the one that
    meets most others in its buckets, the same in all buckets of a family of edited copies."""
    hub = F.max(F.struct("degree", "key", "n", "marks", "tags", "root")).alias("hub")
    blocks = in_blocks(members).join(members.groupBy("bucket").agg(hub), "bucket")
    return blocks.select("members", "hub").mapInArrow(_trees, PAIR_SCHEMA)


def blocks_met(blocks: DataFrame) -> DataFrame:
    """Each block with a member outside its bucket's largest component, with each block of the bucket."""
    others = blocks.select("bucket", F.col("part").alias("other_part"), F.col("members").alias("others"))
    met = blocks.where(F.exists("members", lambda m: m["outside"])).join(others, "bucket")
    return met.select("bucket", "band", "members", F.when(F.col("part") != F.col("other_part"), F.col("others")).alias("others"))


def further_links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between the components that still share buckets: enough of them to tie all that links tie."""
    weight = members.groupBy("bucket", "root").agg(F.count("*").alias("c"))
    main = weight.groupBy("bucket").agg(F.max(F.struct("c", "root"))["root"].alias("main"))
    marked = stored(members.join(main, "bucket").withColumn("outside", F.col("root") != F.col("main")), "marked")
    able = stored(blocks_met(in_blocks(marked, "outside")).mapInArrow(_candidates, "bucket long, key binary").distinct(), "able")
    chosen = sets.join(able.select("key").distinct(), "key", "left_semi")
    full = marked.join(able, ["bucket", "key"], "left_semi").join(chosen, "key")
    blocks = in_blocks(full, "outside", "shingles", weight=F.col("n") / ELEMENTS)
    links = stored(blocks_met(blocks).mapInArrow(_links, PAIR_SCHEMA).distinct(), "links")
    discard(marked)
    discard(able)
    return links


def rooted(members: DataFrame, parts_: DataFrame) -> DataFrame:
    """Bucket members with their component's root; only buckets that hold more than one component."""
    now = members.drop("root").join(parts_.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    mixed = now.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("bucket")
    return now.join(mixed, "bucket")


def link_classes(sets: DataFrame, members: DataFrame) -> DataFrame | None:
    """Components ``node, root`` of the classes that share buckets; None without any link."""
    members = members.withColumn("root", F.col("key"))
    pairs = stored(first_pairs(members).distinct(), "pairs")
    links = stored(confirmed(pairs, sets), "links")
    discard(pairs)
    parts_ = None if links.isEmpty() else stored(components(links), "components")
    mixed = stored(members if parts_ is None else rooted(members, parts_), "members")
    more = further_links(mixed, sets)
    discard(mixed)
    if not more.isEmpty():
        parts_ = stored(components(links.unionByName(more)), "components")
    return parts_


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_shingles``, ``component_id`` (smallest id reachable over links) and ``kept``."""
    ready(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sketched = stored(rows.mapInArrow(_sketched, SKETCH_SCHEMA), "sketches")
    classes = stored(sketched.where("n > 0").groupBy("key").agg(
        F.min("id").alias("id"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("marks").alias("marks"), F.first("tags").alias("tags")), "classes")

    placed = classes.select("key", F.posexplode("bands").alias("band", "bucket"))
    shared = placed.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    met = stored(placed.join(shared, "bucket"), "bucket-members")
    degrees = met.groupBy("key").agg(F.sum("size").alias("degree"))
    known = degrees.join(classes.select("key", "id", "n", "marks", "tags"), "key")
    members = stored(met.drop("size").join(known.drop("id"), "key"), "members")
    wanted = stored(known.select("key", "id"), "wanted")
    discard(met)
    texts = rows.join(wanted.select(F.col("id").alias("chosen")).distinct(), F.col("id").eqNullSafe(F.col("chosen")), "left_semi")
    sets = stored(texts.mapInArrow(_sets, SET_SCHEMA).join(wanted.select("key"), "key", "left_semi").dropDuplicates(["key"]), "sets")

    parts_ = link_classes(sets, members)
    discard(sets)
    discard(members)
    named = classes.select("key", "id")
    if parts_ is None:
        named = named.withColumn("root", F.col("key"))
    else:
        named = named.join(parts_.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    named = stored(named, "named")
    smallest = named.groupBy("root").agg(F.min("id").alias("component_id"))
    of_class = named.join(smallest, "root").select("key", "component_id")
    out = sketched.select("id", "key", "n").join(of_class, "key", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.when(component.isNull(), True).otherwise(F.coalesce(F.col("id") == component, F.lit(False))).alias("kept"),
    )
