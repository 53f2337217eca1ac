"""Near-duplicate vectors by cosine: a subspace pigeonhole join.

Unit vectors with a cosine of ``c`` or more are at most ``2 - 2c`` apart, squared. An orthogonal rotation keeps that; it
is taken from the principal axes of a bounded sample, dealt out to ``BLOCKS`` blocks so that each leads with wide
axes. Each block gets a share of the squared distance in proportion to its variance. A pair within the whole distance
is within its share in some block, or the shares would not add up; so the union of the blocks' range joins holds every
link, whatever the rotation and the shares.

Vectors travel by regions, not by the cells of each block: the leading axes of the whole space are cut at quantiles of the
sample, a vector lies in one region and its ball of the whole radius meets some. A region with more vectors than a task
may hold is dealt into parts. Of two parts that may have links with each other one asks in the other, so that each is asked
by about half of the others; within a part the vectors ask each other. That is one row a vector and one for each part it asks in,
which are ``REGIONS`` at least and grow with the bytes of all vectors, however the blocks are cut.

Within a task the vectors of one part are held and those that ask stream by. The range join of a block cuts its leading
axes at quantiles into cells, more of them the more vectors are held. A held vector lies in one cell, and one that asks
does so in all whose box its ball of the block's radius meets. Block distances pick the candidates, the exact cosine in
double precision decides. A link that several blocks find counts in the first of them only, which the pair's own distances
tell. No pair leaves a task: each vector gives its number of links, and a label for the links' components.

Equal vectors are one class before all this. Where the variance is spread evenly over the axes a ball meets most regions and
more than half of the cells (see the README).

Defined cases: vectors that are NULL, empty, zero or hold NULL or non-finite components link with nothing; vectors of
different lengths don't link; equal vectors link with each other; rows with the same or a NULL ``vec_id`` count as
vectors of their own, and a component's id is its smallest, NULL only where it has no other; labels and other columns are not
read; no rows, no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .components import components

COSINE = 0.95
BLOCKS = 4
MOST = 65536  # vectors that a task holds, fewer where they are long
HELD_BYTES = 32 << 20  # of the vectors that a task holds, in double precision
REGIONS = 16  # of the whole space at least, so that small inputs have tasks enough
SAMPLE = 4096  # vectors for the axes, the shares and the cuts: bounds what goes to the driver, not what is compared
SEED = 12
_SLACK = 1e-9  # rounding of distances; candidates may be a little farther than they should
_CELL = 512  # held vectors to a cell, about
_ASKING = 2048  # vectors that ask at once
_DISTANCES = 1 << 20  # block distances at once
_PAIRS = 1 << 15  # candidates verified at once
_NOTED = 1 << 20  # links noted at once, about
_ROUTED = "slot int, asks boolean, node long, n long, vec binary"
_FOUND = "node long, links long, label long"


class Subspaces:
    """The rotation, blocks, shares and cuts for vectors of one length."""

    def __init__(self, sample: np.ndarray, cells: int, cosine: float = COSINE, blocks: int = BLOCKS) -> None:
        size = sample.shape[1]
        centred = sample - sample.mean(axis=0)
        spread, axes = np.linalg.eigh(centred.T @ centred + 1e-12 * np.eye(size))
        order = np.argsort(-spread, kind="stable")
        blocks = min(blocks, size)
        # Axes by falling variance, dealt to and fro so that the blocks are alike.
        turn = np.concatenate([np.arange(blocks), np.arange(blocks)[::-1]])
        of = np.resize(turn, size)
        members = [order[of == b] for b in range(blocks)]
        self.rotation = axes[:, np.concatenate(members)]
        ends = np.cumsum([0, *map(len, members)])
        self.blocks = [slice(a, b) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        self.starts = ends[:-1]
        variance = np.array([max(spread[m].sum(), 1e-12) for m in members])
        self.cosine = cosine
        self.shares = (2 - 2 * cosine) * variance / variance.sum()
        rotated = centred @ self.rotation + sample.mean(axis=0) @ self.rotation
        self.cuts = [self._cuts(rotated[:, block], cells) for block in self.blocks]

    @staticmethod
    def _cuts(points: np.ndarray, cells: int) -> list[np.ndarray]:
        """Inner bounds of the leading axes' intervals: two on each axis, then more, until there are enough cells."""
        parts = np.ones(points.shape[1], dtype=int)
        at = 0
        while np.prod(parts, dtype=float) < cells and parts.max() < 64:
            parts[at] *= 2
            at = (at + 1) % len(parts)
        return [np.quantile(points[:, i], np.arange(1, p) / p) if len(points) else np.zeros(p - 1) for i, p in enumerate(parts) if p > 1]

    def home(self, b: int, points: np.ndarray) -> np.ndarray:
        code = np.zeros(len(points), dtype=np.int64)
        for i, cuts in enumerate(self.cuts[b]):
            code = code * (len(cuts) + 1) + np.searchsorted(cuts, points[:, i], side="right")
        return code

    def asked(self, b: int, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``row, cell`` for every cell that the ball around a point of block ``b`` meets."""
        row, left = np.arange(len(points)), np.full(len(points), self.shares[b] + 2 * _SLACK)
        code = np.zeros(len(points), dtype=np.int64)
        for i, cuts in enumerate(self.cuts[b]):
            low, high = np.r_[-np.inf, cuts], np.r_[cuts, np.inf]
            x = points[row, i][:, None]
            gap = np.maximum(0, np.maximum(low - x, x - high))
            near, part = np.nonzero(gap * gap <= left[:, None])
            left = left[near] - gap[near, part] ** 2
            row, code = row[near], code[near] * len(low) + part
        return row, code


def _floats(packed: list[bytes], kind: str) -> np.ndarray:
    """Unit vectors in double precision."""
    raw = np.frombuffer(b"".join(packed), kind).reshape(len(packed), -1).astype(np.float64)
    raw = raw / np.abs(raw).max(axis=1, keepdims=True)  # no square overflows
    return raw / np.sqrt(np.einsum("ij,ij->i", raw, raw))[:, None]


class Parts:
    """The slots of the regions, one for each part: tells who is held where and who asks where."""

    def __init__(self, regions: Subspaces, counts: dict[int, int], most: int) -> None:
        self.regions = regions
        self.known = np.array(sorted(counts), np.int64)
        self.width = np.array([-(-counts[c] // most) for c in self.known], np.int64)
        self.first = np.cumsum(np.r_[0, self.width])[:-1]
        self.total = int(self.width.sum())

    def held(self, points: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.known, self.regions.home(0, points))
        dealt = (nodes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        return self.first[at] + dealt.astype(np.int64) % self.width[at]

    def asked(self, points: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``row, slot``: of two slots one asks, the lesser one where their sum is even."""
        row, region = self.regions.asked(0, points)
        at = np.minimum(np.searchsorted(self.known, region), len(self.known) - 1)
        some = self.known[at] == region
        row, at = row[some], at[some]
        times = self.width[at]
        slot = np.repeat(self.first[at] - np.cumsum(np.r_[0, times])[:-1], times) + np.arange(times.sum())
        row = np.repeat(row, times)
        mine = own[row]
        asks = (slot != mine) & ((mine < slot) ^ ((mine + slot) % 2 == 1))
        return row[asks], slot[asks]


def _home(regions: Subspaces, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                units = _floats(batch.column("vec").slice(start, 2048).to_pylist(), kind)
                yield pa.RecordBatch.from_arrays([pa.array(regions.home(0, units @ regions.rotation))], names=["region"])

    return run


def _route(parts: Parts, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                points = _floats(part.column("vec").to_pylist(), kind) @ parts.regions.rotation
                own = parts.held(points, part.column("node").to_numpy())
                row, slot = parts.asked(points, own)
                taken = part.select(["node", "n", "vec"]).take(pa.array(np.concatenate([np.arange(len(own)), row])))
                asks = np.r_[np.zeros(len(own), bool), np.ones(len(row), bool)]
                slots = pa.array(np.concatenate([own, slot]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([slots, pa.array(asks), *taken.columns], names=["slot", "asks", "node", "n", "vec"])

    return run


class Part:
    """The held vectors of one part by the cells of each block, and what those that ask have found among them."""

    def __init__(self, spaces: Subspaces, kind: str, nodes: np.ndarray, counts: np.ndarray, packed: list[bytes]) -> None:
        self.spaces, self.kind, self.nodes, self.counts, self.packed = spaces, kind, nodes, counts, packed
        self.units = _floats(packed, kind)
        self.turned = self.units @ spaces.rotation
        self.blocks = []
        for b, block in enumerate(spaces.blocks):
            points = self.turned[:, block]
            cell = spaces.home(b, points)
            order = np.argsort(cell, kind="stable")
            cells, starts = np.unique(cell[order], return_index=True)
            points = np.ascontiguousarray(points[order])
            self.blocks.append((order, cells, np.r_[starts, len(order)], points, np.einsum("ij,ij->i", points, points)))
        self.links, self.labels = np.zeros(len(nodes), np.int64), nodes.copy()

    def among(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """What the held vectors find among each other. Both ends ask; the greater one's question counts."""
        for at in range(0, len(self.nodes), _ASKING):
            some = slice(at, at + _ASKING)
            yield from self.ask(self.nodes[some], self.counts[some], self.packed[some], among=True)

    def ask(self, nodes: np.ndarray, counts: np.ndarray, packed: list[bytes], among: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``node, links, label`` of those that ask and of held ones whose label has changed."""
        for at in range(0, len(nodes), _ASKING):
            some = slice(at, at + _ASKING)
            noted, size = [], 0
            for i, j in self._found(nodes[some], packed[some], among):
                noted.append((i, j))
                size += len(i)
                if size >= _NOTED:
                    yield self._note(nodes[some], counts[some], *map(np.concatenate, zip(*noted, strict=True)))
                    noted, size = [], 0
            if noted:
                yield self._note(nodes[some], counts[some], *map(np.concatenate, zip(*noted, strict=True)))

    def _found(self, nodes: np.ndarray, packed: list[bytes], among: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Links as pairs of places, among those that ask and among the held, each once."""
        units = _floats(packed, self.kind)
        turned = units @ self.spaces.rotation
        for b, block in enumerate(self.spaces.blocks):
            order, cells, starts, held, squares = self.blocks[b]
            points = np.ascontiguousarray(turned[:, block])
            own = np.einsum("ij,ij->i", points, points)
            near = self.spaces.shares[b] + 2 * _SLACK
            row, cell = self.spaces.asked(b, points)
            by = np.argsort(cell, kind="stable")
            row, cell = row[by], cell[by]
            for c, low, high in zip(cells, starts[:-1], starts[1:], strict=True):
                asking = row[np.searchsorted(cell, c, "left") : np.searchsorted(cell, c, "right")]
                for first in range(low, high, _ASKING):
                    last = min(first + _ASKING, high)
                    step = max(1, _DISTANCES // (last - first))
                    for at in range(0, len(asking), step):
                        some = asking[at : at + step]
                        distance = own[some][:, None] + squares[first:last] - 2 * (points[some] @ held[first:last].T)
                        i, j = np.nonzero(distance <= near)
                        i, j = some[i], order[first + j]
                        if among:
                            later = nodes[i] > self.nodes[j]
                            i, j = i[later], j[later]
                        if len(i):
                            yield self._verified(b, units, turned, i, j)

    def _verified(self, block: int, units: np.ndarray, turned: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        kept = np.zeros(len(i), bool)
        for at in range(0, len(i), _PAIRS):
            a, b = i[at : at + _PAIRS], j[at : at + _PAIRS]
            linked = np.flatnonzero(np.einsum("ij,ij->i", units[a], self.units[b]) >= self.spaces.cosine)
            apart = turned[a[linked]] - self.turned[b[linked]]
            within = np.add.reduceat(apart * apart, self.spaces.starts, axis=1) <= self.spaces.shares + _SLACK
            kept[at + linked[within.argmax(axis=1) == block]] = True
        return i[kept], j[kept]

    def _note(self, nodes: np.ndarray, counts: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        np.add.at(self.links, j, counts[i])
        asking, place = np.unique(i, return_inverse=True)
        links = np.zeros(len(asking), np.int64)
        np.add.at(links, place, self.counts[j])
        own = np.full(len(asking), np.iinfo(np.int64).max)
        before = self.labels.copy()
        while True:  # labels spread along the links until none changes
            old = own.copy()
            np.minimum.at(own, place, self.labels[j])
            held = self.labels.copy()
            np.minimum.at(self.labels, j, own[place])
            if (held == self.labels).all() and (old == own).all():
                break
        # A label that gave way to another is linked to it, so what it stood for before goes along.
        moved = np.unique(np.stack([before, self.labels], axis=1)[before != self.labels], axis=0)
        return (
            np.concatenate([nodes[asking], moved[:, 0]]),
            np.concatenate([links, np.zeros(len(moved), np.int64)]),
            np.concatenate([own, moved[:, 1]]),
        )

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        some = (self.links > 0) | (self.labels != self.nodes)
        return self.nodes[some], self.links[some], self.labels[some]


def _join(spaces: Subspaces, kind: str):
    def out(rows) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in rows], names=["node", "links", "label"])

    def made(held: list) -> Part:
        return Part(spaces, kind, np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), [v for h in held for v in h[2]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, held, part = None, [], None

        def ready() -> Iterator[pa.RecordBatch]:
            nonlocal held, part
            part, held = made(held), []
            yield from map(out, part.among())

        for batch in batches:
            slots = batch.column("slot").to_numpy()
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((slots[1:] != slots[:-1]) | (asks[1:] != asks[:-1])) + 1
            for a, b in zip([0, *edges], [*edges, batch.num_rows], strict=True):
                if a == b:
                    continue
                if slot != slots[a]:
                    if held:
                        yield from ready()
                    if part is not None:
                        yield out(part.rows())
                    slot, part = slots[a], None
                run_ = batch.slice(a, b - a)
                rows = (run_.column("node").to_numpy(), run_.column("n").to_numpy(), run_.column("vec").to_pylist())
                if not asks[a]:
                    held.append(rows)
                    continue
                if held:
                    yield from ready()
                if part is not None:
                    yield from map(out, part.ask(*rows))
        if held:
            yield from ready()
        if part is not None:
            yield out(part.rows())

    return run


def _packed(kind: str):
    """A vector's bytes; NULL for one that can't be compared."""

    def run(vectors: pa.Array) -> pa.Array:
        out = []
        for v in vectors:
            values = v.values if v.is_valid else None
            if values is None or not len(values) or values.null_count:
                out.append(None)
                continue
            x = values.to_numpy(zero_copy_only=False).astype(kind)
            out.append(x.tobytes() if np.isfinite(x).all() and x.any() else None)
        return pa.array(out, pa.binary())

    return F.arrow_udf(run, "binary")


def links_of(classes: DataFrame, kind: str, cosine: float = COSINE, blocks: int = BLOCKS, most: int = MOST) -> DataFrame:
    """``node, links, label`` rows for classes ``node, n, vec`` (bytes of one length each); staged. Runs jobs when called."""
    spark = classes.sparkSession
    found = []
    sizes = [r["bytes"] for r in classes.select(F.octet_length("vec").alias("bytes")).distinct().collect()]  # lengths of vectors
    for size in sorted(sizes):
        some = classes.where(F.octet_length("vec") == size)
        total = some.count()
        sample = some.orderBy(F.xxhash64(F.lit(SEED), F.col("vec")), "vec").limit(SAMPLE).select("vec").collect()
        units = _floats([bytes(r["vec"]) for r in sample], kind)
        held = max(1, min(most, HELD_BYTES // (8 * units.shape[1])))
        regions = Subspaces(units, max(REGIONS, -(-total // held)), cosine, 1)
        counts = some.select("vec").mapInArrow(_home(regions, kind), "region long").groupBy("region").count().collect()  # a row for each region
        parts = Parts(regions, {r["region"]: r["count"] for r in counts}, held)
        spaces = Subspaces(units, max(1, -(-total // (parts.total * _CELL))), cosine, blocks)
        routed = some.select("node", "n", "vec").mapInArrow(_route(parts, kind), _ROUTED)
        routed = routed.repartitionById(parts.total, F.col("slot")).sortWithinPartitions("slot", "asks")
        found.append(stage(routed.mapInArrow(_join(spaces, kind), _FOUND), "found"))
    if not found:
        return spark.createDataFrame([], _FOUND)
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole


def near_duplicates(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", cosine: float = COSINE, blocks: int = BLOCKS, most: int = MOST
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row. Runs jobs when called; each step is staged."""
    single = vectors.schema[embedding].dataType.elementType.simpleString() == "float"
    kind = "<f4" if single else "<f8"
    packed = _packed(kind)(F.col(f"`{embedding}`").cast("array<float>" if single else "array<double>"))
    rows = stage(vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), packed.alias("vec")), "vectors")
    classes = rows.where("vec IS NOT NULL").groupBy("vec").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first"))
    classes = stage(classes.withColumn("node", F.monotonically_increasing_id()), "classes")

    found = links_of(classes.select("node", "n", "vec"), kind, cosine, blocks, most)
    links = stage(found.groupBy("node").agg(F.sum("links").alias("links")), "links")
    roots = components(found.where("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b")))
    placed = classes.join(links, "node", "left").join(roots, "node", "left")
    placed = stage(placed.withColumn("root", F.coalesce("root", "node")).withColumn("links", F.coalesce("links", F.lit(0))), "placed")
    firsts = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    # Only vectors that have a link need to be looked up.
    known = placed.where("links > 0 OR n > 1").join(firsts, "root")
    known = stage(known.select("vec", (F.col("links") + F.col("n") - 1).alias("links"), "component_id", F.lit(True).alias("hit")), "known")
    out = rows.join(known, "vec", "left")
    component = F.when(F.col("hit"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select(
        "vec_id",
        F.coalesce("links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("vec_id")).alias("kept"),
    )
