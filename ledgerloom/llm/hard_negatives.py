"""Hard negatives from Hilbert-ordered blocks with zone maps.

A row's score for an anchor is the integer inner product of their vectors, whose components are
floor(scale * x). An anchor's positives are its best rows of the same label; for each positive the
hard negatives are the best rows of other labels whose score lies between `low` and `high` percent
of the positive's. Higher scores come first, ties by smaller id, a null id last.

1. Rows are ordered along a Hilbert curve through a grid over all dimensions, range-partitioned by
   it, and packed into blocks of `BLOCK` rows, written as Parquet. Each block has the smallest and
   largest value of every dimension (its zone map) and its labels. Blocks that follow each other
   form a segment of a bounded size.
2. For an anchor and a block, interval arithmetic on the zone map encloses all scores: each
   component contributes its product with the lower or the upper end, whichever is larger (or
   smaller). Zone maps and anchors meet in groups of segments and chunks of anchors, and an anchor
   goes to the segments where a block can hold what it looks for, and no others.
3. Positives: an anchor needs the blocks that have its label and whose upper bound reaches its
   fifth-best score of its own block, found while the blocks were at hand, or, inside a
   segment, the fifth-best so far. Negatives: it needs the blocks whose interval meets one of its
   windows, cut by the fifth-best so far. Blocks that no anchor needs are not decoded.
   What the segments return, at most five rows each, is merged by rank.

Anchors are a stated query set, compared with all other rows in blocks; no rows are sampled or
capped. A segment's rows are met by all anchors sent there in batches, so memory holds one segment
and one batch. Scores are exact: in single or double precision where the vectors' norms prove that
every sum is, else in whole numbers of any size; scores beyond 64 bits are compared
and returned as the nearest 64-bit number.

Rows with a null label, a null vector, or a null or non-finite component (after scaling) take no
part; a null id is never an anchor. Shorter vectors are filled up with zeros. Repeated rows are rows of their own:
an anchor that occurs twice is two anchors, each a possible positive of the other. Other columns
are ignored, whatever their names. Without anchors, positives or fitting rows the result is empty.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import lean, staged, table

BLOCK, SEGMENT_BLOCKS = 512, 32
GROUP, CHUNK = 64, 512  # segments and anchors whose zone maps meet in one task
GRID_BITS = 2
BATCH = 128
SINGLE, DOUBLE = float(1 << 24), float(1 << 53)
LONG = (-(1 << 63), (1 << 63) - 1)
NO_ID = LONG[1]

_BLOCKS = ("segment long, block int, ids array<long>, labels array<long>, anchors array<int>, wide boolean, vectors binary, "
           "low array<double>, high array<double>")
_ANCHORS = "segment long, block int, at int, id long, label long, wide boolean, vector binary, reached long"


# -- order and blocks ---------------------------------------------------------------------------

def hilbert_keys(grid: np.ndarray, bits: int) -> list[bytes]:
    """The places of grid points (rows x dimensions, values below 2**bits) on a Hilbert curve, as keys that sort like them.

    Axes are rotated and reflected from the coarsest bit down, Gray-coded, and their bits interleaved.
    """
    x = [grid[:, d].astype(np.uint32) for d in range(grid.shape[1])]
    for bit in range(bits - 1, 0, -1):
        lower = np.uint32((1 << bit) - 1)
        for axis in x:
            reflected = (axis >> np.uint32(bit)) & np.uint32(1) == 1
            swapped = np.where(reflected, np.uint32(0), (x[0] ^ axis) & lower)
            x[0] ^= np.where(reflected, lower, swapped)
            if axis is not x[0]:
                axis ^= swapped
    for before, axis in zip(x, x[1:]):
        axis ^= before
    turned = np.zeros(len(grid), np.uint32)
    for bit in range(bits - 1, 0, -1):
        turned ^= np.where((x[-1] >> np.uint32(bit)) & np.uint32(1) == 1, np.uint32((1 << bit) - 1), np.uint32(0))
    planes = [((axis ^ turned) >> np.uint32(bit)) & np.uint32(1) for bit in range(bits - 1, -1, -1) for axis in x]
    packed = np.packbits(np.stack(planes, axis=1).astype(np.uint8), axis=1)
    return [row.tobytes() for row in packed]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of `width` doubles, filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), width))
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _narrow(values: np.ndarray) -> tuple[bool, np.ndarray]:
    wide = bool(len(values)) and float(np.abs(values).max(initial=0)) > 32767
    return wide, values if wide else values.astype(np.int16)


def _unpacked(wide: bool, data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, np.float64 if wide else np.int16).reshape(-1, width).astype(np.float64)


def _keyed(width: int, scale: float, spread: float):
    """Scaled vectors and their places on the curve; `spread` is the usual size of a component."""
    cells = 1 << GRID_BITS

    @lean
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("vector"), width)
            grid = np.clip(np.floor((x / (2 * spread) + 0.5) * cells), 0, cells - 1)
            wide, values = _narrow(np.floor(x * scale))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), batch.column("anchor"), pa.array([wide] * len(values)),
                 pa.array([v.tobytes() for v in values], pa.binary()), pa.array(hilbert_keys(grid, GRID_BITS), pa.binary())],
                ["id", "label", "anchor", "wide", "vector", "place"])

    return run


def _pack(width: int):
    """Blocks of successive rows of a partition, numbered; each segment of a partition has a number of its own."""
    def block(number, rows):
        ids, labels, anchors, values = rows
        wide, narrow = _narrow(values)
        return [(TaskContext.get().partitionId() << 24) + number // SEGMENT_BLOCKS, number, ids, labels, np.flatnonzero(anchors).tolist(),
                wide, narrow.tobytes(), values.min(axis=0), values.max(axis=0)]

    @lean
    def run(batches):
        number, held, size = 0, [], 0

        def packed(last):
            nonlocal number, held, size
            ids, labels, anchors = (sum((h[i] for h in held), []) for i in range(3))
            values, done, out = np.concatenate([h[3] for h in held]), 0, []
            while size - done >= BLOCK or (last and done < size):
                part = slice(done, done + BLOCK)
                out.append(block(number, (ids[part], labels[part], anchors[part], values[part])))
                number, done = number + 1, done + len(ids[part])
            held, size = [(ids[done:], labels[done:], anchors[done:], values[done:])], size - done
            return out

        def table_of(rows):
            kinds = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.bool_(), pa.binary(),
                     pa.list_(pa.float64()), pa.list_(pa.float64())]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [c.split()[0] for c in _BLOCKS.split(", ")])

        for batch in batches:
            if batch.num_rows:
                wide, data = batch.column("wide").to_pylist(), batch.column("vector").to_pylist()
                values = np.concatenate([_unpacked(w, v, width) for w, v in zip(wide, data)])
                held.append(tuple(batch.column(c).to_pylist() for c in ("id", "label", "anchor")) + (values,))
                size += len(values)
                if size >= BLOCK and (rows := packed(False)):
                    yield table_of(rows)
        if size:
            yield table_of(packed(True))

    return run


def build_blocks(rows: DataFrame, width: int, scale: float) -> DataFrame:
    """The blocks of (id, label, anchor, vector) rows, ordered along the curve, as a written table."""
    n, squares = rows.agg(F.count("*"), F.avg(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))).first()
    spread = math.sqrt(squares / max(1, width)) if squares and math.isfinite(squares) else 1.0
    keyed = rows.mapInArrow(_keyed(width, scale, spread or 1.0), "id long, label long, anchor boolean, wide boolean, vector binary, place binary")
    keyed = staged(keyed, "keyed").withColumn("salt", F.xxhash64("id", "label"))  # equal vectors are split by their ids
    parts = max(1, -(-n // (BLOCK * SEGMENT_BLOCKS)))
    ordered = keyed.repartitionByRange(parts, "place", "salt", "id").sortWithinPartitions("place", "salt", "id", "label")
    return staged(ordered.mapInArrow(_pack(width), _BLOCKS), "blocks")


# -- scores -------------------------------------------------------------------------------------

def _clip(score: int) -> int:
    return min(max(score, LONG[0]), LONG[1])


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers held as doubles."""
    with np.errstate(over="ignore"):
        most = math.sqrt(float((a * a).sum(axis=1).max(initial=0))) * math.sqrt(float((b * b).sum(axis=1).max(initial=0)))
    if most < SINGLE * 0.99:
        return a.astype(np.float32) @ b.astype(np.float32).T
    if most < DOUBLE * 0.99:
        return a @ b.T
    whole = np.frompyfunc(int, 1, 1)
    return np.frompyfunc(_clip, 1, 1)(whole(a) @ whole(b).T)


def _bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores of vectors `a` in boxes, rounded outwards."""
    with np.errstate(over="ignore", invalid="ignore"):
        up, down = np.maximum(a, 0), np.minimum(a, 0)
        slack = (np.abs(a) @ np.maximum(np.abs(low), np.abs(high)).T) * 1e-12
        least, most = up @ low.T + down @ high.T - slack, up @ high.T + down @ low.T + slack
    least, most = np.where(np.isnan(least), -np.inf, least), np.where(np.isnan(most), np.inf, most)
    return np.minimum(least, 9.2e18), np.maximum(most, -9.2e18)  # scores end at 64 bits


def _under(x: int | None) -> float:
    """The largest double that is not above a whole number."""
    if x is None:
        return -math.inf
    near = float(x)
    return near if near <= x else math.nextafter(near, -math.inf)


class _Block:
    """One block of a segment; its vectors are decoded when an anchor needs them."""

    def __init__(self, row: dict, width: int):
        self.segment, self.number, self.labels = row["segment"], row["block"], np.array(row["labels"], np.int64)
        self.ids = np.array([NO_ID if i is None else i for i in row["ids"]], np.int64)
        self.known = np.array([i is not None for i in row["ids"]])
        self._stored, self._vectors, self._width = (row["wide"], row["vectors"]), None, width

    @property
    def vectors(self) -> np.ndarray:
        if self._vectors is None:
            self._vectors = _unpacked(*self._stored, self._width)
        return self._vectors

    def hits(self, mask_row: np.ndarray, scores: np.ndarray) -> list[tuple]:
        """Rows of a mask as (-score, id, segment, block, place, known), which sort as results do."""
        return [(-int(scores[i]), int(self.ids[i]), self.segment, self.number, int(i), bool(self.known[i])) for i in np.flatnonzero(mask_row)]


def _first(found: list[tuple], k: int) -> list[tuple]:
    found.sort()
    return found[:k]


def _own_best(width: int, k: int):
    """Anchors of blocks, with the k-th best score of the same label in their own block."""
    @lean
    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                block = _Block(row, width)
                places = np.array(row["anchors"], np.int64)
                scores = _scores(block.vectors[places], block.vectors)
                for at, own in zip(places, scores):
                    same = block.labels == block.labels[at]
                    same[at] = False
                    best = _first(block.hits(same, own), k)
                    wide, vector = _narrow(block.vectors[at])
                    reached = -best[-1][0] if len(best) == k else None
                    out.append((row["segment"], row["block"], int(at), row["ids"][at], row["labels"][at], wide, vector.tobytes(),
                                reached))
            if out:
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], [c.split()[0] for c in _ANCHORS.split(", ")])

    return run


# -- where anchors meet zone maps and blocks ------------------------------------------------------

def _meet(left: DataFrame, right: DataFrame, keys: list[str], parts: int, load, use, schema: str) -> DataFrame:
    """Rows of `right` in batches beside all rows of `left` of the same key, which must be few: use(load(left rows), right batch)."""
    def side(df, this, other, kind):
        return df.select(*keys, F.struct(*(c for c in df.columns if c not in keys)).alias(this), F.lit(None).cast(kind).alias(other))

    kinds = [F.struct(*(c for c in df.columns if c not in keys)) for df in (left, right)]
    l_type, r_type = (df.select(k.alias("x")).schema["x"].dataType for df, k in zip((left, right), kinds))
    both = side(left, "left", "right", r_type).unionByName(side(right, "right", "left", l_type))
    both = both.repartition(parts, *keys).sortWithinPartitions(*keys, F.col("right").isNotNull())

    @lean
    def run(batches):
        key, parts_of_left, state = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = [batch.column(k).to_numpy() for k in keys] + [batch.column("right").is_valid().to_numpy(zero_copy_only=False)]
            change = np.zeros(batch.num_rows, bool)
            for m in marks:
                change[1:] |= m[1:] != m[:-1]
            edges = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
            for begin, end in zip(edges, edges[1:]):
                now = tuple(m[begin] for m in marks[:-1])
                if now != key:
                    key, parts_of_left, state = now, [], None
                if not marks[-1][begin]:
                    parts_of_left += batch.column("left").slice(begin, end - begin).to_pylist()
                elif parts_of_left:
                    state = load(key, parts_of_left) if state is None else state
                    for at in range(begin, end, BATCH):
                        rows = batch.column("right").slice(at, min(BATCH, end - at)).to_pylist()
                        out = use(state, rows)
                        if out is not None:
                            yield out

    return both.mapInArrow(run, schema)


def _anchor_rows(rows: list[dict], width: int) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([_unpacked(r["wide"], r["vector"], width) for r in rows]), np.array([r["label"] for r in rows], np.int64)


def _limits(values: list) -> np.ndarray:
    return np.array([_under(x) for x in values])


def _windows(row: dict, low: int, high: int) -> list[tuple[int, int]]:
    """The scores, from and to, that the negatives of each positive may have."""
    return [(-(-low * p["score"] // 100), high * p["score"] // 100) for p in row["positives"]]


def _route(anchors: DataFrame, blocks: DataFrame, segments: int, chunks: int, wanted, width: int) -> DataFrame:
    """Anchors beside each `segment` where `wanted(rows, labels, low, high, block labels)` says that they need a block."""
    groups = -(-segments // GROUP)
    zones = blocks.select(F.pmod(F.xxhash64("segment"), F.lit(groups)).cast("int").alias("grp"), F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"),
                          F.col("segment").alias("zone"), "low", "high", F.array_distinct("labels").alias("labels"))
    sent = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp"),
                          F.pmod(F.xxhash64("segment", "block"), F.lit(chunks)).cast("int").alias("chunk"), F.struct(anchors.columns).alias("anchor"))

    def load(key, rows):
        return (np.array([r["zone"] for r in rows]), np.array([r["low"] for r in rows]), np.array([r["high"] for r in rows]),
                [set(r["labels"]) for r in rows])

    def use(state, rows):
        zone, low, high, labels = state
        a, own = _anchor_rows([r["anchor"] for r in rows], width)
        need = wanted([r["anchor"] for r in rows], own, *_bounds(a, low, high), labels)
        at, to = [], []
        for i in range(len(rows)):
            found = np.unique(zone[need[i]]).tolist()
            at += [i] * len(found)
            to += found
        places = [rows[i]["anchor"] for i in at]
        return pa.RecordBatch.from_arrays(
            [pa.array(to, pa.int64()), pa.array([p["segment"] for p in places], pa.int64()), pa.array([p["block"] for p in places], pa.int32()),
             pa.array([p["at"] for p in places], pa.int32())], ["zone", "segment", "block", "at"]) if to else None

    routes = _meet(zones, sent, ["grp", "chunk"], max(1, min(groups * chunks, 4096)), load, use, "zone long, segment long, block int, at int")
    return routes.join(anchors, ["segment", "block", "at"])


def _has_label(own: np.ndarray, labels: list[set]) -> np.ndarray:
    return np.array([[label in block for block in labels] for label in own.tolist()])


def _has_other(own: np.ndarray, labels: list[set]) -> np.ndarray:
    return np.array([[bool(block - {label}) for block in labels] for label in own.tolist()])


def _search(routed: DataFrame, blocks: DataFrame, segments: int, find, width: int, schema: str) -> DataFrame:
    """What `find(blocks of a segment, bounds, anchors)` returns where routed anchors meet their segments."""
    def load(key, rows):
        held = [_Block({**r, "segment": key[0]}, width) for r in sorted(rows, key=lambda r: r["block"])]
        low, high = (np.array([r[side] for r in sorted(rows, key=lambda r: r["block"])]) for side in ("low", "high"))
        return held, low, high, [set(r["labels"]) for r in sorted(rows, key=lambda r: r["block"])]

    def use(state, rows):
        held, low, high, labels = state
        anchors = [r["anchor"] for r in rows]
        a, own = _anchor_rows(anchors, width)
        found = find(held, labels, _bounds(a, low, high), anchors, a, own)
        if not found:
            return None
        columns = list(zip(*found))
        kinds = {"long": pa.int64(), "int": pa.int32()}
        return pa.RecordBatch.from_arrays([pa.array(c, kinds[f.split()[1]]) for c, f in zip(columns, schema.split(", "))],
                                          [f.split()[0] for f in schema.split(", ")])

    left = blocks.withColumnRenamed("segment", "zone")
    right = routed.select("zone", F.struct(*(c for c in routed.columns if c != "zone")).alias("anchor"))
    return _meet(left, right, ["zone"], max(1, min(segments, 65536)), load, use, schema)


def _found_rows(anchor: dict, best: list[tuple], *more) -> list[tuple]:
    return [(anchor["segment"], anchor["block"], anchor["at"], *more, i if known else None, -s, z, b, p) for s, i, z, b, p, known in best]


def _find_positives(k: int):
    def find(held, labels, bounds, anchors, a, own):
        best = [[] for _ in anchors]
        reached = [r["reached"] for r in anchors]
        need, most = _has_label(own, labels), bounds[1]
        for b in np.argsort(-most.max(axis=0)).tolist():
            block, limits = held[b], _limits(reached)
            rows = np.flatnonzero(need[:, b] & (most[:, b] >= limits))
            if not len(rows):
                continue
            scores = _scores(a[rows], block.vectors)
            fits = (block.labels[None, :] == own[rows][:, None]) & (scores >= limits[rows][:, None])
            for i in np.flatnonzero(fits.any(axis=1)).tolist():
                r = anchors[rows[i]]
                if r["segment"] == block.segment and r["block"] == block.number:
                    fits[i, r["at"]] = False
                mine = best[rows[i]] = _first(best[rows[i]] + block.hits(fits[i], scores[i]), k)
                if len(mine) == k:
                    reached[rows[i]] = max(-mine[-1][0], LONG[0] if reached[rows[i]] is None else reached[rows[i]])
        return [x for r, found in zip(anchors, best) for x in _found_rows(r, found)]

    return find


def _find_negatives(k: int, low: int, high: int):
    def find(held, labels, bounds, anchors, a, own):
        windows = [_windows(r, low, high) for r in anchors]
        best = [[[] for _ in w] for w in windows]
        count = max(map(len, windows))
        # limits per window; a window that is not there takes nothing
        least = np.array([[_under(w[j][0]) if j < len(w) else np.inf for j in range(count)] for w in windows])
        most = np.array([[-_under(-w[j][1]) if j < len(w) else -np.inf for j in range(count)] for w in windows])
        need = _has_other(own, labels)
        for b in np.argsort(-bounds[1].max(axis=0)).tolist():
            block = held[b]
            meets = ((bounds[1][:, b][:, None] >= least) & (bounds[0][:, b][:, None] <= most) & (least <= most)).any(axis=1) & need[:, b]
            rows = np.flatnonzero(meets)
            if not len(rows):
                continue
            scores = _scores(a[rows], block.vectors)
            others = block.labels[None, :] != own[rows][:, None]
            for j in range(count):
                fits = others & (scores >= least[rows, j][:, None]) & (scores <= most[rows, j][:, None])
                for i in np.flatnonzero(fits.any(axis=1)).tolist():
                    at = rows[i]
                    if scores.dtype == object or abs(most[at, j]) >= DOUBLE:  # limits held as doubles are near, not exact
                        fits[i] &= np.array([windows[at][j][0] <= int(s) <= windows[at][j][1] for s in scores[i]])
                    mine = best[at][j] = _first(best[at][j] + block.hits(fits[i], scores[i]), k)
                    if len(mine) == k:
                        least[at, j] = max(least[at, j], _under(-mine[-1][0]))
        return [x for r, each in zip(anchors, best) for p, found in zip(r["positives"], each) for x in _found_rows(r, found, p["rank"])]

    return find


# -- the operator ---------------------------------------------------------------------------------

def _ranked(df: DataFrame, keys: str, k: int) -> DataFrame:
    order = "score DESC, id ASC NULLS LAST, z, b, p"
    return df.withColumn("rank", F.expr(f"row_number() OVER (PARTITION BY {keys} ORDER BY {order})")).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | str = "label",
                   positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: float = 256.0) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows where `anchors` holds."""
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"),
                          F.coalesce(anchors & F.col(f"`{id_col}`").isNotNull(), F.lit(False)).alias("anchor"),
                          F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    whole = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x * scale) < math.inf))
    rows = rows.where(F.col("label").isNotNull() & F.col("vector").isNotNull() & whole)
    width = max(1, rows.agg(F.max(F.size("vector"))).first()[0] or 0)
    blocks = build_blocks(rows, width, scale)
    segments = max(1, blocks.select("segment").distinct().count())
    mine = staged(blocks.where(F.size("anchors") > 0).mapInArrow(_own_best(width, positives), _ANCHORS), "anchors")
    chunks = max(1, -(-mine.count() // CHUNK))
    place = ["segment", "block", "at"]

    def near_enough(rows, own, least, most, labels):
        return _has_label(own, labels) & (most >= _limits([r["reached"] for r in rows])[:, None])

    def in_window(rows, own, least, most, labels):
        out = np.zeros(most.shape, bool)
        for i, r in enumerate(rows):
            for start, end in _windows(r, low, high):
                if start <= end:
                    out[i] |= (most[i] >= _under(start)) & (least[i] <= -_under(-end))
        return out & _has_other(own, labels)

    found = "segment long, block int, at int, id long, score long, z long, b int, p int"
    routed = _route(mine, blocks, segments, chunks, near_enough, width)
    best = _ranked(_search(routed, blocks, segments, _find_positives(positives), width, found), "segment, block, at", positives)
    chosen = best.groupBy(*place).agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("positives"))  # a few per anchor
    asked = staged(mine.join(chosen, place), "asked")
    found = "segment long, block int, at int, positive int, id long, score long, z long, b int, p int"
    routed = _route(asked, blocks, segments, chunks, in_window, width)
    best = _ranked(_search(routed, blocks, segments, _find_negatives(negatives, low, high), width, found), "segment, block, at, positive", negatives)
    best = best.select(*place, "positive", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    one = F.get("positives", F.col("positive") - 1)
    joined = best.join(asked.select(*place, F.col("id").alias("anchor_id"), "positives"), place)
    return joined.select("anchor_id", one["id"].alias("positive_id"), F.col("rank").cast("int").alias("rank"), "negative_id",
                         one["score"].alias("positive_score"), "negative_score")


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Anchors are the vectors whose id is divisible by 100; ids divisible by 7 have the next label."""
    vectors = table(spark, folder, "embeddings")
    key, label = F.col("vec_id"), F.col("label")
    return hard_negatives(vectors, key % 100 == 0, label=F.when(key % 7 == 0, (label + 1) % 10).otherwise(label))


OP12_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS place, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.place AS anchor, a.vec_id AS anchor_id, a.label = b.label AS same, b.place, b.vec_id, list_inner_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.place <> b.place),
p AS (
  SELECT anchor, anchor_id, place, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, place) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
WINDOW w AS (PARTITION BY p.anchor, p.place ORDER BY s.score DESC, s.vec_id, s.place) QUALIFY rank <= 5
"""
