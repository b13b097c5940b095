"""N-gram Jaccard join: an R-tree over count vectors, split at its root by exact groups.

A text is a set of hashed word shingles.  Tokens of a set are hashed into groups.
Sets that link differ in few tokens, so with more groups than that at least one
group has the same tokens in both: the root of the tree has one region for each
content of a group, and a set is in the regions of all its groups but as many of
the commonest as linked sets share beyond one.  Within a
region, sets are points of group counts, packed into boxes; the sum over the
groups of the smaller count bounds the overlap of a set with a box or a set, and
what survives is verified on the sets themselves.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starlane.llm.components import components
from starlane.llm.texts import as_bytes, give_back, hashes, map_steps, rolling, steps, table
from starlane.session import materialize, scratch

_SALTS = 4
_ODD = np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class Similarity:
    """Shingle length, the least Jaccard percentage, and the tree's shape.

    ``axes`` groups make a point, ``leaf`` points a box, and a region of more
    than ``most`` points is searched in pairs of parts.
    """

    words: int = 4
    percent: int = 85
    axes: int = 1024
    leaf: int = 16
    most: int = 4096
    rounds: int = 2

    def differing(self, size: int) -> int:
        """Tokens in which a set of ``size`` and a linked larger one differ at most."""
        return 100 * size // self.percent * (100 - self.percent) // 100

    def classes(self, largest: int) -> list[tuple[int, int, int]]:
        """(lowest size, highest size, groups) of the size classes up to ``largest``."""
        out, low = [], 1
        while low <= largest:
            high = max(low, low * 3 // 2)
            differing = self.differing(high)
            # A quarter more than can differ: enough that few sets are dealt again.
            out.append((low, high, differing + 2 + differing // 4 if differing else 0))
            low = high + 1
        return out


def shingles(body: bytes, length: int) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    words = hashes(body.lower().split())
    return np.unique(rolling(words, min(length, max(len(words), 1))))


def digest(tokens: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).astype(np.int64))


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _ODD
    return values ^ (values >> np.uint64(29))


def deals(
    tokens: np.ndarray, classes: list[tuple[int, int, int]], how: Similarity
) -> Iterator[tuple[int, int, np.ndarray]]:
    """(deal, spare, regions): the regions of a set, one for each of its groups in its own size
    class, and in each lower class that may hold a set linked to it.

    Two sets may agree in empty groups only.  A class has more groups than can
    differ by a margin; a set with more empty groups than the margin is dealt
    again by another hash, so that of two linked sets that share no filled group
    both are dealt again, and after the last deal gives its empty groups too.

    Linked sets share more filled groups of a deal than the margin without the
    empty groups of either.  By that ``spare`` regions of the deal may be left
    out, the first in an order that is the same for all sets: of the regions that
    two linked sets share, the last has ``spare`` others before it in both.
    """
    for number, (low, high, groups) in enumerate(classes):
        if low > len(tokens):
            break
        if not groups or 100 * high < how.percent * len(tokens):
            continue
        margin = groups - how.differing(high) - 1
        for salt in range(_SALTS):
            # Groups follow the order of the hashes, so a group's tokens stand together.
            dealt = tokens if not salt else np.sort(_mixed(tokens + np.uint64(salt)))
            group = ((dealt >> np.uint64(32)) * np.uint64(groups)) >> np.uint64(32)
            first = np.flatnonzero(np.diff(group, prepend=np.uint64(groups)))
            content = np.add.reduceat(_mixed(dealt), first)
            where = np.uint64((number * _SALTS + salt) << 32) + group[first]
            empty = groups - len(first)
            deal = number * (_SALTS + 1) + salt
            yield deal, max(margin - empty, 0), _mixed(content + _mixed(where)).view(np.int64)
            if empty <= margin:
                break
        else:
            missing = np.setdiff1d(np.arange(groups, dtype=np.uint64), group[first])
            yield deal + 1, 0, _mixed(np.uint64((number * _SALTS + _SALTS) << 32) + missing).view(np.int64)


def regions(tokens: np.ndarray, classes: list[tuple[int, int, int]], how: Similarity) -> np.ndarray:
    """The regions of all deals of a set."""
    return np.concatenate([*(x for _, _, x in deals(tokens, classes, how)), np.empty(0, dtype=np.int64)])


def same_text() -> F.Column:
    """A hash of the row's text, which with its doc_id names the row or an exact copy of it."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def signed(docs: DataFrame, how: Similarity) -> DataFrame:
    """doc_id, same, n_shingles and digest of each row."""
    key = docs.schema["doc_id"].dataType.simpleString()

    def work(step: pa.RecordBatch) -> dict[str, object]:
        found = [shingles(body, how.words) for body in step.column("body").to_pylist()]
        return {
            "doc_id": step.column("doc_id"), "same": step.column("same"),
            "n_shingles": pa.array(list(map(len, found)), pa.int64()),
            "digest": pa.array([digest(x) if len(x) else None for x in found], pa.int64()),
        }

    bodies = as_bytes(docs.withColumn("same", same_text()), "doc_id", "same")
    return materialize(map_steps(bodies, work, f"doc_id {key}, same long, n_shingles long, digest long"), "shingle-sets")


def in_regions(docs: DataFrame, how: Similarity) -> DataFrame:
    """digest, deal, spare and regions (see ``deals``) of each set; a task gives a set once.

    Regions are the larger part of what is known of a set and are read once, so
    they are not written out but made from the texts on their way to the shuffle.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[int] = set()
        classes = how.classes(64)
        for step in steps(batches):
            names, found = [], []
            for body in step.column("body").to_pylist():
                tokens = shingles(body, how.words)
                name = digest(tokens)
                if not len(tokens) or name in given:
                    continue
                if len(tokens) > classes[-1][1]:
                    classes = how.classes(2 * len(tokens))
                own = list(deals(tokens, classes, how))
                names.extend([name] * len(own))
                found.extend(own)
                given.add(name)
            if not found:
                continue
            number, spare, own = zip(*found)
            cuts = np.cumsum([0, *map(len, own)])
            yield pa.RecordBatch.from_pydict({
                "digest": pa.array(names, pa.int64()), "deal": pa.array(number, pa.int32()),
                "spare": pa.array(spare, pa.int32()),
                "regions": pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(np.concatenate(own))),
            })
        give_back()

    return as_bytes(docs).mapInArrow(run, "digest long, deal int, spare int, regions array<long>")


def shared_regions(sets: DataFrame) -> DataFrame:
    """region, digest, lead (its smallest digest) and size of the regions of two and more sets.

    A set is not in the commonest regions of a deal, as many as it can spare.
    These are those of passages that stand in many texts, whose sets would all be
    compared with each other.  Of regions with the same sets one stays.
    """
    rows = sets.select(F.explode("regions").alias("region"), "digest", "deal", "spare")
    whole = Window.partitionBy("region")
    rows = rows.select(
        "region", "digest", "deal", "spare", F.min("digest").over(whole).alias("first"),
        F.max("digest").over(whole).alias("last"), F.count("*").over(whole).alias("times"),
    )
    rows = rows.where("first <> last").drop("first", "last").distinct()
    common = Window.partitionBy("digest", "deal").orderBy(F.desc("times"), "region")
    rows = rows.withColumn("place", F.row_number().over(common)).where("place > spare").select("region", "digest")
    with scratch(sets.sparkSession) as keep:
        rows = materialize(rows, "regions")
        members = rows.groupBy("region").agg(
            F.min("digest").alias("lead"), F.count("*").alias("size"),
            F.sum(F.xxhash64("digest").cast("decimal(38,0)")).alias("all"),
        )
        kept = members.where("size > 1").groupBy("lead", "size", "all").agg(F.min("region").alias("region"))
        return keep(rows.join(kept.drop("all"), "region"), "shared-regions")


def points(docs: DataFrame, wanted: DataFrame, how: Similarity) -> DataFrame:
    """digest, tokens (the set) and counts (the point, compressed) of the sets ``wanted`` (doc_id, same, digest)."""

    def work(step: pa.RecordBatch) -> dict[str, object]:
        digests, tokens, counts = [], [], []
        for body, name in zip(step.column("body").to_pylist(), step.column("digest").to_pylist()):
            own = shingles(body, how.words)
            if digest(own) == name:
                digests.append(name)
                tokens.append(own.tobytes())
                axis = (_mixed(own) >> np.uint64(40)) % np.uint64(how.axes)
                count = np.bincount(axis.astype(np.int64), minlength=how.axes)
                kind = "<u1" if count.max() < 1 << 8 else "<u4"
                counts.append(zstandard.compress(count.astype(kind).tobytes(), 1))
        return {"digest": pa.array(digests, pa.int64()), "tokens": pa.array(tokens, pa.binary()),
                "counts": pa.array(counts, pa.binary())}

    # Repeated rows go here, where the join has brought them together, and not as sets.
    bodies = as_bytes(docs.withColumn("same", same_text()), "doc_id", "same").alias("a").join(
        wanted.alias("b"), F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.same") == F.col("b.same"))
    )
    bodies = bodies.select("a.body", "b.digest").dropDuplicates(["digest"])
    return materialize(map_steps(bodies, work, "digest long, tokens binary, counts binary"), "points")


def _enough(overlap: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of ``sizes`` tokens together link, if so many are in both."""
    return overlap * (100 + percent) >= percent * sizes


class CountTree:
    """An R-tree over points of group counts, packed from the bottom."""

    def __init__(self, counts: np.ndarray, leaf: int):
        self.counts, self.leaf = counts, leaf
        self.sizes = counts.sum(axis=1, dtype=np.int64)
        # Sums of axes, whose bound is looser and takes a quarter of the time.
        self.folded = self._fold(counts)
        self.order = np.arange(len(counts))
        if len(counts) > leaf:
            # Neighbours in size, then along the axes that vary most.
            axes = np.argsort(-counts.var(axis=0), kind="stable")[:3]
            self.order = np.lexsort([*[counts[:, k] for k in axes[::-1]], np.log2(self.sizes + 1).astype(int)])
        tops, lows = counts[self.order], self.sizes[self.order]
        self.levels = [(tops, self._fold(tops), lows)]
        while len(tops) > leaf:
            starts = np.arange(0, len(tops), leaf)
            tops, lows = np.maximum.reduceat(tops, starts), np.minimum.reduceat(lows, starts)
            self.levels.append((tops, self._fold(tops), lows))

    @staticmethod
    def _fold(counts: np.ndarray) -> np.ndarray:
        fold = 4 if counts.shape[1] % 4 == 0 else 1
        sums = counts.reshape(len(counts), -1, fold).sum(axis=2, dtype=np.int64)
        return sums.astype("<u2" if sums.max(initial=0) >> 8 else "<u1") if sums.max(initial=0) < 1 << 16 else sums

    def _bound(self, points: np.ndarray, query: np.ndarray, tops: np.ndarray, box: np.ndarray) -> np.ndarray:
        bound = np.empty(len(query), dtype=np.int64)
        # No bound is larger than the query's size.
        kind = np.uint16 if self.sizes.max(initial=0) < 1 << 16 else np.int64
        for a in range(0, len(query), 512):
            part = slice(a, a + 512)
            bound[part] = np.minimum(points[query[part]], tops[box[part]]).sum(axis=1, dtype=kind)
        return bound

    def search(
        self, queries: np.ndarray, percent: int, apart: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs (query, other point) whose bound allows a link, and the bound; with ``apart``
        only of points that differ in it."""
        tops = self.levels[-1][0]
        query = np.repeat(queries, len(tops))
        box = np.tile(np.arange(len(tops)), len(queries))
        for level in range(len(self.levels) - 1, -1, -1):
            tops, folded, lows = self.levels[level]
            if not level:
                # Points: those whose sizes allow it.
                ok = _enough(np.minimum(self.sizes[query], lows[box]), self.sizes[query] + lows[box], percent)
                if apart is not None:
                    ok &= apart[query] != apart[self.order[box]]
                query, box = query[ok], box[ok]
            for points, over in ((self.folded, folded), (self.counts, tops)):
                bound = self._bound(points, query, over, box)
                ok = _enough(bound, self.sizes[query] + lows[box], percent)
                query, box, bound = query[ok], box[ok], bound[ok]
            if level:
                below = len(self.levels[level - 1][0])
                child = box[:, None] * self.leaf + np.arange(self.leaf)
                query = np.repeat(query, self.leaf)[(child < below).ravel()]
                box = child[child < below]
        return query, self.order[box], bound


def _candidates(
    names: np.ndarray, comp: np.ndarray, packed: list[bytes], best: bool, how: Similarity
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a region's sets in different components that may link; with ``best`` only each
    set with the closest to it."""
    counts = [zstandard.decompress(x) for x in packed]
    counts = [np.frombuffer(x, f"<u{len(x) // how.axes}") for x in counts]
    tree = CountTree(np.stack(counts), how.leaf)
    pairs = []
    for low in range(0, len(names), 256):
        query, other, bound = tree.search(np.arange(low, min(low + 256, len(names))), how.percent, comp)
        if best and len(query):
            closeness = bound / (tree.sizes[query] + tree.sizes[other])
            order = np.lexsort([other, -closeness, query])
            query, other = query[order], other[order]
            new = np.append(True, np.diff(query) != 0)
            query, other = query[new], other[new]
        a, b = names[query], names[other]
        pairs.append(np.stack([np.minimum(a, b), np.maximum(a, b)]))
    return np.unique(np.concatenate(pairs, axis=1), axis=1)


def candidates(shared: DataFrame, comps: DataFrame, spots: DataFrame, best: bool, how: Similarity) -> DataFrame:
    """region and pairs (a, b) across components that share it and pass the tree's bound.

    They are short and written out, so the shuffle of points is gone before sets are shuffled.
    """
    rows = shared.join(comps.withColumnRenamed("node", "digest"), "digest", "left")
    rows = rows.withColumn("comp", F.coalesce("comp", "digest"))
    mixed = rows.groupBy("region").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y")
    rows = rows.join(mixed.select("region"), "region").join(spots.select("digest", "counts"), "digest")
    # A region beyond ``most`` is dealt into parts, and each pair of parts is searched.
    parts = F.ceil(F.col("size") / how.most)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("digest"), parts))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    grouped = rows.groupBy(
        "region", F.least("part", "with").alias("low"), F.greatest("part", "with").alias("high")
    ).agg(F.collect_list(F.struct("digest", "comp", "counts")).alias("sets"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for region, sets in zip(batch.column("region").to_pylist(), batch.column("sets")):
                sets = sets.values
                names, comp = (sets.field(n).to_numpy(zero_copy_only=False) for n in ("digest", "comp"))
                a, b = _candidates(names, comp, sets.field("counts").to_pylist(), best, how)
                if len(a):
                    yield pa.RecordBatch.from_pydict({"region": np.full(len(a), region), "a": a, "b": b})
        give_back()

    return materialize(grouped.select("region", "sets").mapInArrow(run, "region long, a long, b long"), "candidate-pairs")


def verified(pairs: DataFrame, spots: DataFrame, how: Similarity) -> DataFrame:
    """The pairs (a, b) that link, by the sets themselves."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = (np.frombuffer(v.as_buffer(), "<u8") for v in (x, y))
                small, large = (x, y) if len(x) < len(y) else (y, x)
                ok = 100 * len(small) >= how.percent * len(large)
                if ok:
                    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                    both = np.count_nonzero(large[at] == small)
                    ok = 100 * both >= how.percent * (len(x) + len(y) - both)
                keep.append(ok)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
        give_back()

    sides = pairs.join(spots.select(F.col("digest").alias("a"), F.col("tokens").alias("x")), "a")
    sides = sides.join(spots.select(F.col("digest").alias("b"), F.col("tokens").alias("y")), "b")
    return materialize(sides.select("a", "b", "x", "y").mapInArrow(run, "a long, b long"), "verified")


def linked_sets(docs: DataFrame, sets: DataFrame, how: Similarity) -> DataFrame:
    """node (a digest of ``sets``, see ``signed``) and comp of the sets that link with another."""
    shared = shared_regions(in_regions(docs, how))
    wanted = sets.select("doc_id", "same", "digest").join(shared.select("digest").distinct(), "digest")
    # One row of each set, with an id if any has one.
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "same")
    wanted = wanted.groupBy("digest").agg(F.min(row).alias("row")).select("digest", "row.doc_id", "row.same")
    spots = points(docs, wanted, how)
    stars = shared.where("digest <> lead").groupBy("lead", "digest").agg(F.count("*").alias("n"))
    stars = stars.groupBy("digest").agg(F.max_by("lead", F.struct("n", -F.col("lead"))).alias("lead"))
    links = verified(stars.select(F.col("lead").alias("a"), F.col("digest").alias("b")), spots, how)
    comps = components(links)
    for best in [True] * how.rounds + [False]:
        pairs = candidates(shared, comps, spots, best, how)
        links = links.unionByName(verified(pairs.select("a", "b").distinct(), spots, how))
        comps = components(links)
        if best:
            # Components only grow: a region without a pair will never have one.
            shared = materialize(shared.join(pairs.select("region").distinct(), "region", "left_semi"), "pair-regions")
    return comps


def linked(docs: DataFrame, how: Similarity = Similarity()) -> DataFrame:
    """doc_id, same (see ``same_text``), n_shingles, comp (equal for linked rows, null without shingles) and component_id (the smallest doc_id reachable by links) for each
    row of ``docs`` (doc_id, text).

    Equal sets are one node.  A null or empty text has no shingles and is linked
    with nothing, so its component is its own id; a row with a null doc_id counts
    but is no candidate for the smallest id.  Every pair that links is found, or
    joined already by other links: first each set is verified against the leader
    that it shares most regions with, then in regions that still hold several
    components each set against the closest in another, and at last all that the
    bound allows.
    """
    sets = signed(docs, how)
    # What the search writes, the points above all, is larger than its result and goes with its end.
    with scratch(docs.sparkSession) as keep:
        comps = keep(linked_sets(docs, sets, how), "components")
    named = sets.join(comps.withColumnRenamed("node", "digest"), "digest", "left")
    named = named.withColumn("comp", F.coalesce("comp", "digest"))
    smallest = named.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    named = named.join(smallest, "comp", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return named.select("doc_id", "same", "n_shingles", "comp", component.alias("component_id"))


def jaccard_join(docs: DataFrame, how: Similarity = Similarity()) -> DataFrame:
    """doc_id, n_shingles and component_id of each row of ``docs``; see ``linked``."""
    return linked(docs, how).select("doc_id", "n_shingles", "component_id")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))
