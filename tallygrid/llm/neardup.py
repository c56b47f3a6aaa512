"""Near duplicates by an inverted join over MinHash signature coordinates.

Each distinct shingle set gets M coordinates, each the combination of R minima, so
that unrelated sets rarely agree on one. A set is posted under its first M - T + 1
(coordinate, value) pairs: two sets that agree on T coordinates must meet there.

Large groups of copies do not become all their pairs. Identical sets are one class
from the start. Star rounds compare every posting list with one of its members: pairs
with too few equal coordinates or minima drop, the rest is confirmed on the full sets
and links components. Sets that were close to the same members are one cluster. In a
cluster, those outside its largest component are compared with all of it, block
against block; between clusters, sets are compared if they share one of their rarest
shingles, of which the rarest 20 % (and one more) of two similar sets must meet.

With M = 40, R = 4, T = 3, a pair of similarity 0.8 is missed with probability
below 1e-6, and a pair of similarity 0.05 agrees once with probability 3e-4.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallygrid.llm.components import components
from tallygrid.llm.frames import small_batches
from tallygrid.llm.text import LOWER, chunks, grams, mix, row_starts, seeded, signed, slices, utf8, word_hashes, words
from tallygrid.session import broadcast_if_small, materialize

COORDINATES, ROWS_EACH, MATCHES = 40, 4, 3
# Standard deviations below the expected number of equal bytes at the threshold that a pair may fall.
SLACK = 5.5
# Sets of a block pair: outliers of a cluster against members.
BLOCK_OUTLIERS, BLOCK_MEMBERS = 256, 1024
# Another star round follows while comparing the outliers of all clusters with their clusters would take more pairs than this
# for each posting, if the last round has halved them, and up to so many rounds.
WORK_PER_POSTING, STAR_ROUNDS = 100, 4


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and 64-bit hash of every distinct k-word shingle, by row and hash; A-Z count as a-z.

    A text of fewer words has its whole sequence as its only shingle; without words it has none.
    """
    data, offsets = utf8(texts)
    data = LOWER[data]
    starts, ends, rows = words(data, offsets)
    hashes = word_hashes(data, starts, ends)
    many = np.bincount(rows, minlength=len(texts)) if len(rows) else np.zeros(len(texts), np.int64)
    g, at = grams(hashes, rows, k)
    parts = [(rows[at], g)]
    for m in range(1, k):
        short = many[rows] == m if len(rows) else np.zeros(0, bool)
        if short.any():
            g, at = grams(hashes[short], rows[short], m, seed=m)
            parts.append((rows[short][at], g))
    row, h = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    return row[new], h[new]


def signatures(h: np.ndarray, starts: np.ndarray, coordinates: int, rows_each: int) -> tuple[np.ndarray, np.ndarray]:
    """M combined minima of each segment of h, and one byte of each of the M * R minima."""
    low = (h & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    high = (h >> np.uint64(32)).astype(np.uint32)
    keys = seeded(5, coordinates * rows_each)
    out = np.zeros((len(starts), coordinates), np.uint64)
    sketch = np.zeros((len(starts), coordinates * rows_each), np.uint8)
    v = np.empty_like(low)
    for k, key in enumerate(keys.tolist()):
        np.bitwise_xor(low, np.uint32(key & 0xFFFFFFFF), out=v)
        v *= np.uint32(key >> 32 | 1)
        v ^= high
        v *= np.uint32(0x9E3779B1)
        least = mix(np.minimum.reduceat(v, starts).astype(np.uint64) + np.uint64(1))
        sketch[:, k] = least & np.uint64(0xFF)
        c = k // rows_each
        out[:, c] = mix(out[:, c] ^ least) + np.uint64(c)
    return out, sketch


def _features(k: int, coordinates: int, rows_each: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            row, h = shingle_sets(batch.column("text"), k)
            n = np.bincount(row, minlength=batch.num_rows).astype(np.int64)
            s1, s2 = np.zeros(batch.num_rows, np.uint64), np.zeros(batch.num_rows, np.uint64)
            starts = row_starts(row)
            sig, sketch = [None] * batch.num_rows, [None] * batch.num_rows
            if len(starts):
                own = row[starts]
                s1[own] = np.add.reduceat(mix(h ^ np.uint64(0x5851F42D4C957F2D)), starts)
                s2[own] = np.add.reduceat(mix(h + np.uint64(0x14057B7EF767814F)), starts)
                for r, coords, low in zip(own.tolist(), *signatures(h, starts, coordinates, rows_each)):
                    sig[r], sketch[r] = signed(coords), low.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n), pa.array(signed(s1)), pa.array(signed(s2)), pa.array(sig, pa.list_(pa.int64())), pa.array(sketch, pa.binary())],
                ["doc_id", "n", "s1", "s2", "sig", "sketch"],
            )

    return run


def _confirm(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text_b", 1 << 20):
            ra, ha = shingle_sets(batch.column("text_a"), k)
            rb, hb = shingle_sets(batch.column("text_b"), k)
            row, h = np.concatenate([ra, rb]), np.concatenate([ha, hb])
            order = np.lexsort((h, row))
            row, h = row[order], h[order]
            same = (row[1:] == row[:-1]) & (h[1:] == h[:-1])
            common = np.bincount(row[1:][same], minlength=batch.num_rows)
            either = np.bincount(row, minlength=batch.num_rows) - common
            linked = (either > 0) & (100 * common >= percent * either)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(linked))

    return run


def _agreeing(matches: int, least: float):
    """Pairs with enough equal coordinates and enough equal bytes of the minima."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (batch.column(c).flatten().to_numpy().reshape(batch.num_rows, -1) for c in ("sig_a", "sig_b"))
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("sketch_a", "sketch_b"))
                keep = ((a == b).sum(axis=1) >= matches) & ((x == y).sum(axis=1) >= least)
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep))

    return run


def _shingle_rows(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            row, h = shingle_sets(batch.column("text"), k)
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays([pa.array(signed(h)), *(batch.column(c).take(at) for c in ("rep", "cluster", "n"))], ["h", "rep", "cluster", "n"])

    return run


def _rare_pairs(members: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs of sets in different clusters that share one of their rarest shingles and may be similar enough.

    Shingles of one cluster only come first in the common order, then by documents
    and hash; they fill the front of a set's prefix without meeting anything.
    """
    used = texts.join(broadcast_if_small(members), texts["id"] == members["rep"])
    used = materialize(used.select("rep", "cluster", "n", "text"), "member-texts")
    rows = used.mapInArrow(_shingle_rows(k), "h long, rep long, cluster long, n long")
    mixed = rows.groupBy("h").agg(F.min("cluster").alias("low"), F.max("cluster").alias("high"), F.count(F.lit(1)).alias("df")).filter("low < high").select("h", "df")
    shared = rows.join(mixed, "h")
    by_rep = Window.partitionBy("rep", "n")  # the shingles of one document
    ranked = shared.withColumn("s", F.count(F.lit(1)).over(by_rep)).withColumn("place", F.row_number().over(by_rep.orderBy("df", "h")))
    # The prefix has n - ceil(percent * n / 100) + 1 places; the n - s shingles of one cluster only take the first.
    prefix = F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100) + 1 - (F.col("n") - F.col("s"))
    rare = materialize(ranked.filter(F.col("place") <= prefix).select("h", "rep", "cluster", "n", "s"), "rare")
    met = rare.groupBy("h").agg(F.min("cluster").alias("low"), F.max("cluster").alias("high")).filter("low < high").select("h")
    rare = materialize(rare.join(met, "h", "left_semi"), "mixed")
    x, y = rare.alias("x"), rare.alias("y")
    # At most the smaller number of shared shingles can be common.
    possible = (100 + percent) * F.least("x.s", "y.s") >= percent * (F.col("x.n") + F.col("y.n"))
    pairs = x.join(y, (F.col("x.h") == F.col("y.h")) & (F.col("x.cluster") < F.col("y.cluster")) & _sizes("x.n", "y.n", percent) & possible)
    return pairs.select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")).distinct()


def _block_links(k: int, percent: int):
    """Links between the outliers and the members of one block pair, from an inverted index over the members."""

    def run(block: pa.Table) -> pa.Table:
        block = block.combine_chunks()
        outer = block.column("outlier").to_numpy()
        sides = [block.filter(pa.array(outer)).combine_chunks(), block.filter(pa.array(~outer)).combine_chunks()]
        (ra, ha), (rb, hb) = ((np.zeros(0, np.int64), np.zeros(0, np.uint64)) if not side.num_rows else shingle_sets(side.column("text").chunk(0), k) for side in sides)
        na, nb = (np.bincount(r, minlength=side.num_rows) for r, side in ((ra, sides[0]), (rb, sides[1])))
        pa_, pb = (side.column("part").to_numpy() for side in sides)
        order = np.argsort(hb, kind="stable")
        hb, rb = hb[order], rb[order]
        first, last = np.searchsorted(hb, ha, "left"), np.searchsorted(hb, ha, "right")
        begin = np.searchsorted(ra, np.arange(sides[0].num_rows + 1))
        found_a, found_b = [], []
        for i in range(sides[0].num_rows):
            lo, many = first[begin[i] : begin[i + 1]], (last - first)[begin[i] : begin[i + 1]]
            shift = np.repeat(lo - (np.cumsum(many) - many), many)
            common = np.bincount(rb[np.arange(many.sum()) + shift], minlength=sides[1].num_rows)
            hit = np.flatnonzero((100 * common >= percent * (na[i] + nb - common)) & (pb != pa_[i]) & (common > 0))
            found_a += [i] * len(hit)
            found_b += hit.tolist()
        a, b = (side.column("rep").to_numpy()[np.array(at, np.int64)] for side, at in zip(sides, (found_a, found_b)))
        return pa.table({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64())})

    return run


def _links_inside(members: DataFrame, sizes: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links between different parts of one cluster: sets outside its largest part against all, in blocks."""
    own = members.join(broadcast_if_small(sizes), "cluster").select("cluster", "rep", "part", "n", "top", F.ceil(F.col("size") / BLOCK_MEMBERS).alias("b"), F.ceil(F.col("n_out") / BLOCK_OUTLIERS).alias("o"))
    own = materialize(own, "clustered")
    with_text = texts.join(broadcast_if_small(own), own["rep"] == texts["id"]).drop("id")
    place = F.xxhash64("rep", F.lit(1))
    out = with_text.filter("part != top").withColumn("i", F.pmod(place, F.col("o"))).withColumn("j", F.explode(F.expr("sequence(0L, b - 1)")))
    all_ = with_text.withColumn("j", F.pmod(place, F.col("b"))).withColumn("i", F.explode(F.expr("sequence(0L, o - 1)")))
    columns = ["cluster", "i", "j", "rep", "part", "text"]
    both = out.select(*columns, F.lit(True).alias("outlier")).unionByName(all_.select(*columns, F.lit(False).alias("outlier")))
    return both.groupBy("cluster", "i", "j").applyInArrow(_block_links(k, percent), "a long, b long").distinct()


def _links(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets are similar enough; only texts that occur in a pair are moved."""
    ids = broadcast_if_small(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), derived=True)
    used = texts.join(ids, "id", "left_semi")
    both = pairs.join(used.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    both = both.join(used.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_confirm(k, percent), "a long, b long")


def near_duplicates(
    docs: DataFrame,
    k: int = 5,
    percent: int = 80,
    coordinates: int = COORDINATES,
    rows_each: int = ROWS_EACH,
    matches: int = MATCHES,
    star_rounds: int = STAR_ROUNDS,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * intersection >= percent * union of their sets of
    lower-cased k-word shingles; component_id is the smallest doc_id reachable.
    Null and empty texts have no shingles and are linked with nothing; a text of
    fewer than k words counts as one shingle. Rows that repeat a doc_id are one
    document in the graph and keep their own rows. A null doc_id forms no links and
    has itself (null) as component, and is kept. Other columns are ignored; no
    documents give no rows. Runs jobs and writes tables below the shared folder.
    """
    small_batches(docs)
    first, many_rows = coordinates - matches + 1, coordinates * rows_each
    least_equal = many_rows * percent / 100 - SLACK * (many_rows * percent / 100 * (1 - percent / 100)) ** 0.5
    source = docs.select("doc_id", "text")
    each = materialize(source.mapInArrow(_features(k, coordinates, rows_each), "doc_id long, n long, s1 long, s2 long, sig array<long>, sketch binary"), "sets")
    # Identical sets: one class, represented by its smallest doc_id.
    reps = materialize(each.filter("n > 0 AND doc_id IS NOT NULL").groupBy("n", "s1", "s2", "sig", "sketch").agg(F.min("doc_id").alias("rep")), "classes")
    postings = reps.select(F.explode(F.slice("sig", 1, first)).alias("key"), "rep", "n")
    shared = postings.groupBy("key").agg(F.count(F.lit(1)).alias("many")).filter("many > 1")
    posted = materialize(postings.join(shared.select("key"), "key", "left_semi"), "posted")
    texts = source.filter("doc_id IS NOT NULL").select(F.col("doc_id").alias("id"), "text")
    n_posted = posted.count()

    sides = [reps.select(F.col("rep").alias(c), F.col("sig").alias(f"sig_{c}"), F.col("sketch").alias(f"sketch_{c}")) for c in "ab"]

    def close(pairs: DataFrame) -> DataFrame:
        met = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "sig_a", "sig_b", "sketch_a", "sketch_b")
        return materialize(met.mapInArrow(_agreeing(matches, least_equal), "a long, b long").distinct(), "agreeing")

    sides = [reps.select(F.col("rep").alias(c), F.col("sig").alias(f"sig_{c}"), F.col("sketch").alias(f"sketch_{c}")) for c in "ab"]

    def close(pairs: DataFrame) -> DataFrame:
        met = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "sig_a", "sig_b", "sketch_a", "sketch_b")
        return materialize(met.mapInArrow(_agreeing(matches, least_equal), "a long, b long").distinct(), "agreeing")

    parts, live = None, posted.withColumn("part", F.col("rep"))
    near = links = before = None
    for turn in range(star_rounds if n_posted else 0):
        found = close(_star(live, "part", turn, percent))
        new = materialize(_links(found, texts, k, percent), "confirmed")
        near, links = (found, new) if near is None else (near.unionByName(found), links.unionByName(new))
        parts, clusters = components(links, "a", "b"), components(near, "a", "b")
        members = _labelled(_labelled(posted.select("rep", "n").distinct(), parts, "part"), clusters, "cluster")
        members = materialize(members, "members")
        sizes = materialize(_open_clusters(members), "clusters")
        work = sizes.agg(F.sum(F.col("size") * F.col("n_out"))).first()[0] or 0
        if work <= WORK_PER_POSTING * n_posted or (before is not None and 2 * work > before):
            break
        before, live = work, _labelled(posted, parts, "part")
    if parts is not None:
        links = links.unionByName(materialize(_links_inside(members, sizes, texts, k, percent), "inside"))
        across = _open(posted, members)
        if across is not None:
            pairs = _rare_pairs(across, texts, k, percent)
            links = links.unionByName(materialize(_links(close(pairs), texts, k, percent), "confirmed"))
        parts = components(links, "a", "b")

    classes = reps.select("n", "s1", "s2", "rep")
    if parts is not None:
        classes = classes.join(parts.select(F.col("id").alias("rep"), "component"), "rep", "left").select("n", "s1", "s2", F.coalesce("component", "rep").alias("rep"))
    joined = each.filter("n > 0 AND doc_id IS NOT NULL").drop("sig", "sketch").join(classes, ["n", "s1", "s2"])
    alone = each.filter("n = 0 OR doc_id IS NULL").select("n", "s1", "s2", "doc_id", F.col("doc_id").alias("rep"))
    both = joined.select("n", "s1", "s2", "doc_id", "rep").unionByName(alone)
    return both.select("doc_id", F.col("n").alias("n_shingles"), F.col("rep").alias("component_id"), F.col("doc_id").eqNullSafe(F.col("rep")).alias("kept"))


def _labelled(rows: DataFrame, labels: DataFrame | None, name: str) -> DataFrame:
    """The rows with the component of their rep, itself if it has none."""
    if labels is None:
        return rows.withColumn(name, F.col("rep"))
    return rows.join(labels.select(F.col("id").alias("rep"), "component"), "rep", "left").withColumn(name, F.coalesce("component", "rep")).drop("component")


def _open_clusters(members: DataFrame) -> DataFrame:
    """Clusters of several parts: their size, their largest part, and how many sets are outside of it."""
    counts = members.groupBy("cluster", "part").agg(F.count(F.lit(1)).alias("c"))
    each = counts.groupBy("cluster").agg(F.sum("c").alias("size"), F.max(F.struct("c", "part")).alias("top"), F.count(F.lit(1)).alias("n_parts"))
    return each.filter("n_parts > 1").select("cluster", F.col("top.part").alias("top"), "size", (F.col("size") - F.col("top.c")).alias("n_out"))


def _open(posted: DataFrame, members: DataFrame) -> DataFrame | None:
    """Sets in lists that hold several clusters: (rep, n, cluster); None if there are none."""
    labelled = posted.select("key", "rep", "n").join(members.select("rep", "cluster").distinct(), "rep")
    keys = labelled.groupBy("key").agg(F.min("cluster").alias("low"), F.max("cluster").alias("high")).filter("low < high").select("key")
    live = materialize(labelled.join(keys, "key", "left_semi").select("rep", "n", "cluster").distinct(), "live")
    return None if live.isEmpty() else live


def _star(live: DataFrame, name: str, turn: int, percent: int) -> DataFrame:
    """Each member of a list with one member of another label, which is another one in every round."""
    turned = F.lit(int(seeded(turn, 1)[0]) >> 1 if turn else 0)
    first = F.min(F.struct(F.col("rep").bitwiseXOR(turned).alias("place"), F.col("rep").alias("centre"), F.col(name).alias("centre_label"), F.col("n").alias("centre_n")))
    centres = live.groupBy("key").agg(first.alias("c")).select("key", "c.centre", "c.centre_label", "c.centre_n")
    pairs = live.join(centres, "key").filter(F.col(name) != F.col("centre_label")).filter(_sizes("n", "centre_n", percent))
    return pairs.select(F.least("centre", "rep").alias("a"), F.greatest("centre", "rep").alias("b")).distinct()


def _sizes(a: str, b: str, percent: int):
    """Sets whose sizes alone allow the similarity."""
    return 100 * F.least(F.col(a), F.col(b)) >= percent * F.greatest(F.col(a), F.col(b))
