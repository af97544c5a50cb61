"""MinHash near-duplicates by an inverted join on signature coordinates.

Documents with equal shingle sets are one class. A class is posted under its (coordinate, value) pairs. Two
sets of Jaccard similarity 0.8 agree in about 51 of 64 coordinates, and in fewer than MATCHES once in 10^8
cases, so it is enough to meet in one of the m - MATCHES + 1 rarest of a class's m shared pairs: the prefix.
Values that a common passage brings into many documents are the least rare and stay outside prefixes.

Posting lists are not multiplied out. Every member is first compared with the least member of its lists, the
hub; lists that lie in one component then are done. In the others, each member outside the list's largest
component is sent to the homes (least hubs) of the list's members and compared there, inside a task, with all
members of other components. All links are confirmed on full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatterlens.llm._components import components
from chatterlens.llm._hash import mixed, runs, word_numbers
from chatterlens.llm._rows import packed, unpacked
from chatterlens.llm._tables import numbered, store

COORDINATES = 64
MATCHES = 32
#: Of 128 sketch bits, two a coordinate, most that differ: six standard deviations beyond the mean at 0.8.
MOST_BITS = 40
#: Shingles that are hashed together.
GROUP = 1 << 16
MEMBERS_PER_PLACE = 500
SHINGLES_PER_PLACE = 1 << 20
SALTS = 16
_seeds = mixed(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
XORS, ODDS = _seeds[:COORDINATES], _seeds[COORDINATES:] | np.uint64(1)
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingle_set(data: bytes, width: int) -> np.ndarray:
    """Sorted numbers of the distinct shingles; a shorter text is one shingle."""
    words = word_numbers(data.translate(LOWER).split())
    return np.unique(runs(words, min(width, len(words)))) if len(words) else np.zeros(0, np.uint64)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of COORDINATES 32-bit values per non-empty set."""
    out = np.zeros((len(sets), COORDINATES), np.uint32)
    first = 0
    while first < len(sets):
        last, total = first, 0
        while last < len(sets) and (last == first or total + len(sets[last]) <= GROUP):
            total += len(sets[last])
            last += 1
        line = np.concatenate(sets[first:last])
        starts = np.cumsum([0, *map(len, sets[first : last - 1])])
        for k in range(COORDINATES):
            out[first:last, k] = np.minimum.reduceat((line ^ XORS[k]) * ODDS[k], starts) >> np.uint64(32)
        first = last
    return out


def sketched(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, rid, n (shingles), digest of the set, sig; one pass over the texts."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, width) for t in batch.column(2).to_pylist()]
            full = [i for i, s in enumerate(sets) if len(s)]
            sig = [None] * len(sets)
            for i, row in zip(full, signatures([sets[i] for i in full])):
                sig[i] = row.view(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), pa.array(sig, pa.list_(pa.int32())),
                ],
                names=["doc_id", "rid", "n", "digest", "sig"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "rid", "text").mapInArrow(sketch, f"doc_id {kind}, rid long, n long, digest binary, sig array<int>")


def postings(classes: DataFrame) -> DataFrame:
    """token, rep, n, lo, hi: each class under the rarest of its (coordinate, value) pairs that others share."""
    pairs = classes.select("rep", F.posexplode("sig").alias("k", "value")).select(
        "rep", F.expr("shiftleft(cast(k as bigint), 32) | (cast(value as bigint) & 4294967295)").alias("token")
    )
    shared = pairs.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    ranked = pairs.join(shared.hint("merge"), "token").groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("all"))
    prefix = ranked.where(F.size("all") >= MATCHES).select("rep", F.explode(F.expr(f"slice(all, 1, size(all) - {MATCHES - 1})").getField("token")).alias("token"))
    bits = [
        F.aggregate(F.slice("sig", at, 32), F.lit(0).cast("bigint"), lambda s, v: F.shiftleft(s, 2).bitwiseOR(v.cast("bigint").bitwiseAND(F.lit(3)))).alias(name)
        for name, at in (("lo", 1), ("hi", 33))
    ]
    return prefix.join(classes.select("rep", "n", *bits), "rep")


def likely(a: str, b: str):
    """Whether sizes and sketches allow a similarity of 0.8."""
    return F.expr(
        f"100 * least({a}.n, {b}.n) >= 80 * greatest({a}.n, {b}.n)"
        f" and bit_count({a}.lo ^ {b}.lo) + bit_count({a}.hi ^ {b}.hi) <= {MOST_BITS}"
    )


def delivered(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Texts of `docs` (rid, text), compressed, for each row of `wanted` (rid, home, place, side, component);
    rows of a home and place lie together, side 0 first."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([press(t) for t in batch.column(1).to_pylist()], pa.binary())], names=["rid", "z"])

    texts = docs.select("rid", "text").mapInArrow(pack, "rid long, z binary")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Merge joins whatever the size: what is sent grows with the input in one way.
    sent = texts.join(wanted.hint("merge"), "rid").select("home", "place", "side", "rid", "component", "z")
    return sent.repartition(n, "home", "place").sortWithinPartitions("home", "place", "side")


def similar(mine: np.ndarray, other: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(mine, other, assume_unique=True))
    return 100 * both >= percent * (len(mine) + len(other) - both)


def links_to_hubs(docs: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets have at least `percent` hundredths in common. The text of b
    travels to a's place; an a with more than MEMBERS_PER_PLACE partners has several places."""
    sizes = pairs.groupBy("a").agg(F.expr(f"cast(ceil(count(*) / {MEMBERS_PER_PLACE}) as int)").alias("places"))
    routed = pairs.join(sizes.hint("merge"), "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("places")).cast("int").alias("place"))
    sides = [
        routed.select(F.col(rid).alias("rid"), F.col("a").alias("home"), "place", F.lit(side).alias("side"), F.lit(0).cast("long").alias("component"))
        for side, rid in enumerate("ab")
    ]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor().decompress
        mine = None
        for batch in batches:
            found = []
            for home, side, rid, z in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 5))):
                if side == 0:
                    mine = shingle_set(open_(z), width)
                elif similar(mine, shingle_set(open_(z), width), percent):
                    found.append((home, rid))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return delivered(docs, sides[0].distinct().unionByName(sides[1])).mapInArrow(compare, "a long, b long")


class Place:
    """Members of one place: which of them are similar to a set, by counting common shingles for all at once."""

    def __init__(self, members: list[tuple[int, int, np.ndarray]]):
        self.rids, self.components = np.array([m[0] for m in members]), np.array([m[1] for m in members])
        self.sizes = np.array([len(m[2]) for m in members])
        line = np.concatenate([m[2] for m in members])
        order = np.argsort(line, kind="stable")
        self.line, self.owners = line[order], np.repeat(np.arange(len(members)), self.sizes)[order]

    def links(self, component: int, other: np.ndarray, percent: int) -> list[int]:
        """A similar member of each other component."""
        lo, hi = np.searchsorted(self.line, other, "left"), np.searchsorted(self.line, other, "right")
        width = hi - lo
        at = np.repeat(hi - np.cumsum(width), width) + np.arange(width.sum())
        both = np.bincount(self.owners[at], minlength=len(self.rids))
        alike = (100 * both >= percent * (self.sizes + len(other) - both)) & (self.components != component)
        _, first = np.unique(self.components[alike], return_index=True)
        return self.rids[alike][first].tolist()


def links_to_homes(docs: DataFrame, visits: DataFrame, members: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) between each visitor of `visits` (rid, component, home) and the members of that home, as
    `members` (rid, component, home, n) has them, of other components. Homes are cut into places of about
    SHINGLES_PER_PLACE shingles; a visitor goes to each place."""
    # One home may have a third of all members: a salt spreads its rows, and each home is listed once a salt.
    salts = F.explode(F.expr(f"sequence(0, {SALTS - 1})")).alias("salt")
    salt = F.pmod(F.xxhash64("rid"), F.lit(SALTS)).cast("int")
    homes = visits.select("home").distinct().select("home", salts)
    there = members.withColumn("salt", salt).join(homes.hint("merge"), ["home", "salt"])
    places = there.groupBy("home").agg(F.expr(f"cast(ceil(sum(n) / {SHINGLES_PER_PLACE}) as int)").alias("places")).select("home", "places", salts)
    hosts = there.join(places, ["home", "salt"]).select("rid", "home", F.pmod(F.xxhash64("rid"), F.col("places")).cast("int").alias("place"), F.lit(0).alias("side"), "component")
    guests = visits.withColumn("salt", salt).join(places, ["home", "salt"]).select("rid", "home", F.explode(F.expr("sequence(0, places - 1)")).alias("place"), F.lit(1).alias("side"), "component")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor().decompress
        key, members, place = None, [], None
        for batch in batches:
            found = []
            for home, number, side, rid, component, z in zip(*(c.to_pylist() for c in batch.columns)):
                if (home, number) != key:
                    key, members, place = (home, number), [], None
                data = shingle_set(open_(z), width)
                if side == 0:
                    members.append((rid, component, data))
                elif members:
                    place = place or Place(members)
                    found += [(min(rid, m), max(rid, m)) for m in place.links(component, data, percent)]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return delivered(docs, hosts.unionByName(guests)).mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, rid, n_shingles, component (least rid reachable) for every row of `docs` (doc_id, text).

    Null, empty and blank texts have no shingles and are alone. Copies share a component whatever their number.
    Rows without or with repeated ids: see `numbered`. Empty tables give empty results.
    """
    rows = numbered(docs)
    known = store(sketched(rows, width), "signatures")
    classes = store(known.where("n > 0").groupBy("digest").agg(F.min("rid").alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig")), "classes")
    posted = store(postings(classes), "postings")
    hubs = posted.groupBy("token").agg(F.min_by(F.struct("rep", "n", "lo", "hi"), "rep").alias("h"))
    starred = posted.alias("p").join(hubs.select("token", "h.*").alias("q").hint("merge"), "token")
    pairs = starred.where(F.expr("p.rep > q.rep") & likely("p", "q")).select(F.col("q.rep").alias("a"), F.col("p.rep").alias("b")).distinct()
    links = store(links_to_hubs(rows, store(pairs, "pairs"), width, percent), "links")
    found = components(links)
    # What is left: lists with members of several components.
    label = found.select(F.col("node").alias("rep"), "component")
    homes = starred.groupBy(F.col("p.rep").alias("rep"), F.col("p.n").alias("n")).agg(F.min("q.rep").alias("home"))
    members = store(
        homes.join(label.hint("merge"), "rep", "left").select(F.col("rep").alias("rid"), "home", "n", F.coalesce("component", "rep").alias("component")), "members"
    )
    tagged = posted.select("token", F.col("rep").alias("rid")).join(members.hint("merge"), "rid")
    main = (
        tagged.groupBy("token", "component").agg(F.count("*").alias("n")).groupBy("token")
        .agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.count("*").alias("k")).where("k > 1")
    )
    open_ = store(tagged.join(main.hint("merge"), "token").select("token", "rid", "component", "home", "main"), "open")
    there = open_.select("token", "home").distinct()
    visits = store(open_.where("component <> main").select("token", "rid", "component").join(there.hint("merge"), "token").select("rid", "component", "home").distinct(), "visits")
    more = store(links_to_homes(rows, visits, members, width, percent), "more")
    if more.limit(1).count():
        found = components(links.unionByName(more))
    own = known.drop("sig").join(classes.select("digest", "rep").hint("merge"), "digest", "left").withColumn("node", F.coalesce("rep", "rid"))
    return own.join(found.hint("merge"), "node", "left").select("doc_id", "rid", F.col("n").alias("n_shingles"), F.coalesce("component", "node").alias("component"))


def first_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` that are first of their component, with their own columns only, whatever they are called.

    Rows equal in id and text are one document: one of them stays.
    """
    kept = near_duplicates(docs.select("doc_id", "text"), width, percent).where("rid = component")
    if docs.where("doc_id is null").limit(1).count() or docs.groupBy("doc_id").count().where("count > 1").limit(1).count():
        slim = numbered(docs.select("doc_id", "text")).select(F.col("doc_id").alias("_id"), F.col("rid").alias("_rid"), F.xxhash64("text").alias("_digest")).distinct()
        keys = slim.join(kept.select(F.col("rid").alias("_rid")).distinct(), "_rid")
        digest = F.xxhash64(F.coalesce("text", F.lit("")).cast("binary"))
        once = docs.select(packed(docs).alias("row"), "doc_id", digest.alias("digest")).dropDuplicates(["doc_id", "digest"])
        some = once.join(keys, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left_semi")
        return some.select(*unpacked(docs, "row"))
    whole = docs.select(packed(docs).alias("row"), "doc_id")
    return whole.join(kept.select(F.col("doc_id").alias("_id")), F.col("doc_id") == F.col("_id"), "left_semi").select(*unpacked(docs, "row"))
