"""Hard negatives of anchors, by exact integer products of tiles.

Rows are packed into tiles of integers; the anchors, a stated part of the rows,
into panels of their own. Every panel meets every tile once in a cell of a
grid, where Strassen's recursion multiplies them: matrices are cut into
quarters, odd sides filled with zeros, seven products replace eight, and all
additions are those of 64-bit integers. Scores never leave a task. What does is
a heap for each anchor: of its best rows of the same label (positives), and in
a second pass, which knows the positives, of the best rows of other labels in
the window of scores below each positive. Heaps of one anchor are merged inside
a task first and then by the panel.

Defined results: rows without id or label, without a vector, or with a component
that is null, NaN or infinite take no part. Rows that are equal in id, label and
vector are one row; rows that share an id only are different rows, but none is a
positive of an anchor with its own id. Of equal scores the smaller id goes first.
A shorter vector goes on with zeros; an empty one scores 0. An anchor without
positives, and a positive without negatives, give no row. Scores that may leave
64 bits are an error, not a wrong number. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedplan.operators.lookup import salts_of
from feedplan.sources.staging import staged

#: Side of a product that is not cut further.
LEAF = 32


@dataclass(frozen=True)
class Mining:
    """Rows kept for an anchor and for a positive; the window in per cent of the positive's score; anchors of a panel,
    panels of a block, rows of a tile, rows of it multiplied at once, heaps that a task holds."""

    positives: int = 5
    negatives: int = 5
    low: int = 80
    high: int = 100
    panel: int = 1024
    panels: int = 16
    tile: int = 8192
    strip: int = 2048
    held: int = 64


def _leaf(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    """The product of two small matrices; as doubles where no sum can leave the 53 bits in which they are exact."""
    return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64) if exact else a @ b


def _even(m: np.ndarray) -> np.ndarray:
    rows, columns = m.shape
    return np.pad(m, ((0, rows % 2), (0, columns % 2))) if rows % 2 or columns % 2 else m


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """a @ b for int64 matrices, exact as long as the result fits 64 bits."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most >= 2.0**62:
        raise OverflowError("scores do not fit 64 bits")
    # a cut doubles the entries of both factors at most, and halves the inner side
    depth, side = 0, min(*a.shape, b.shape[1])
    while side > leaf:
        depth, side = depth + 1, (side + 1) // 2
    return _product(a, b, depth, most * 2.0**depth < 2.0**52)


def _product(a: np.ndarray, b: np.ndarray, depth: int, exact: bool) -> np.ndarray:
    if not depth:
        return _leaf(a, b, exact)
    rows, columns = a.shape[0], b.shape[1]
    a, b = _even(a), _even(b)
    r, k, c = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:r, :k], a[:r, k:], a[r:, :k], a[r:, k:]
    b11, b12, b21, b22 = b[:k, :c], b[:k, c:], b[k:, :c], b[k:, c:]
    p = [
        _product(x, y, depth - 1, exact)
        for x, y in (
            (a11 + a22, b11 + b22), (a21 + a22, b11), (a11, b12 - b22), (a22, b21 - b11),
            (a11 + a12, b22), (a21 - a11, b11 + b12), (a12 - a22, b21 + b22),
        )
    ]
    out = np.empty((2 * r, 2 * c), np.int64)
    out[:r, :c] = p[0] + p[3] - p[4] + p[6]
    out[:r, c:] = p[2] + p[4]
    out[r:, :c] = p[1] + p[3]
    out[r:, c:] = p[0] - p[1] + p[2] + p[5]
    return out[:rows, :columns]


Heap = tuple[np.ndarray, np.ndarray, np.ndarray]


def best(slot: np.ndarray, score: np.ndarray, id_: np.ndarray, most: int) -> Heap:
    """The first entries of each slot: higher scores first, then smaller ids. Merging heaps is this, over both."""
    order = np.lexsort((id_, ~score, slot))
    slot, score, id_ = slot[order], score[order], id_[order]
    new = np.append(True, slot[1:] != slot[:-1]) if len(slot) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    rank = np.arange(len(slot)) - np.repeat(first, np.diff(np.append(first, len(slot))))
    kept = rank < most
    return slot[kept], score[kept], id_[kept]


def merged(heaps: list[Heap], most: int) -> Heap:
    return best(*(np.concatenate([h[i] for h in heaps]) for i in range(3)), most)


_WIDTHS = {1: np.int8, 2: np.int16, 4: np.int32, 8: np.int64}
_TILE = "number bigint, n int, dim int, width int, ids binary, labels binary, cells binary"


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Vectors as rows, shorter ones filled up with zeros."""
    sizes = vectors.value_lengths().to_numpy()
    flat = vectors.flatten().to_numpy()
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


def _pack(rows: DataFrame, size: int) -> DataFrame:
    """Tiles of up to `size` rows of (id, label, vector), in order of label and id, in integers as narrow as they fit.
    The number of a tile has the task in its upper bits."""

    def tile(batches: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches)
        ids, labels = (table[c].to_numpy() for c in ("id", "label"))
        cells = _matrix(table["vector"].combine_chunks())
        order = np.lexsort((ids, labels))
        width = next(w for w, kind in _WIDTHS.items() if w == 8 or not cells.size or (cells.min() >= np.iinfo(kind).min and cells.max() <= np.iinfo(kind).max))
        binary = [ids[order].tobytes(), labels[order].tobytes(), cells[order].astype(_WIDTHS[width]).tobytes()]
        numbers = [pa.array([number], pa.int64())] + [pa.array([x], pa.int32()) for x in (len(ids), cells.shape[1], width)]
        return pa.record_batch(numbers + [pa.array([x], pa.binary()) for x in binary], ["number", "n", "dim", "width", "ids", "labels", "cells"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, filled = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, size - filled)
                held.append(part)
                at, filled = at + part.num_rows, filled + part.num_rows
                if filled == size:
                    yield tile(held, number)
                    number, held, filled = number + 1, [], 0
        if filled:
            yield tile(held, number)

    return rows.select("id", "label", "vector").mapInArrow(pack, _TILE)


def _unpacked(row: dict, prefix: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels = (np.frombuffer(row[prefix + c], np.int64) for c in ("ids", "labels"))
    cells = np.frombuffer(row[prefix + "cells"], _WIDTHS[row[prefix + "width"]])
    return ids, labels, cells.reshape(row[prefix + "n"], row[prefix + "dim"]).astype(np.int64)


def _cells(tiles: DataFrame, panels: DataFrame, blocks: int, lanes: int) -> DataFrame:
    """Every tile next to every panel: both are dealt to the cells (block of panels, lane of tiles) of a grid."""
    parts = salts_of(tiles.sparkSession)
    one = tiles.select(F.expr(f"pmod(xxhash64(number), {lanes})").alias("lane"), F.expr(f"explode(sequence(0, {blocks - 1}))").alias("block"), "*")
    own = [F.col(c).alias(f"p_{c}") for c in panels.columns]
    other = panels.select(F.expr(f"explode(sequence(0L, {lanes - 1}L))").alias("lane"), F.expr("cast(shiftright(number, 32) as int)").alias("block"), *own)
    # the work of a cell is not in proportion to its bytes: tasks must not be merged by size
    one, other = (x.repartition(parts, "block", "lane") for x in (one, other))
    return one.join(other, ["block", "lane"]).drop("block", "lane")


_HEAP = "panel bigint, slots binary, scores binary, ids binary"


def _heap_row(panel: int, heap: Heap) -> pa.RecordBatch:
    return pa.record_batch([pa.array([panel], pa.int64()), *(pa.array([x.astype(np.int64).tobytes()], pa.binary()) for x in heap)], ["panel", "slots", "scores", "ids"])


def _heap_of(row: dict, prefix: str = "") -> Heap:
    return tuple(np.frombuffer(row[prefix + c], np.int64) for c in ("slots", "scores", "ids"))


def _common(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Components that both have; the rest would be multiplied by zero."""
    dim = min(a.shape[1], b.shape[1])
    return a[:, :dim], b[:, :dim]


def _positives(row: dict, mining: Mining) -> Heap:
    """Of one cell, the best rows of the label of each anchor; slots are the anchors' places in their panel."""
    ids, labels, cells = _unpacked(row, "")
    anchors, wanted, vectors = _unpacked(row, "p_")
    cells, vectors = _common(cells, vectors)
    found: list[Heap] = []
    for label in np.unique(wanted):
        to, at = (slice(*np.searchsorted(x, [label, label + 1])) for x in (labels, wanted))
        for begin in range(to.start, to.stop, mining.strip):
            part = slice(begin, min(begin + mining.strip, to.stop))
            scores = strassen(vectors[at], np.ascontiguousarray(cells[part].T))
            other = anchors[at][:, None] != ids[part][None, :]
            scores[~other] = np.iinfo(np.int64).min
            n = scores.shape[1]
            if n > mining.positives:
                least = np.partition(scores, n - mining.positives, axis=1)[:, n - mining.positives]
                other &= scores >= least[:, None]
            slot, place = np.nonzero(other)
            found.append(best(slot + at.start, scores[slot, place], ids[part][place], mining.positives))
    return merged(found, mining.positives) if found else best(*np.zeros((3, 0), np.int64), 1)


def _negatives(row: dict, mining: Mining) -> Heap:
    """Of one cell, the best rows of other labels in the window of each positive; slots are those of the positives:
    anchor times positives plus rank."""
    ids, labels, cells = _unpacked(row, "")
    _, own, vectors = _unpacked(row, "p_")
    slots, tops, _ = _heap_of(row, "h_")
    cells, vectors = _common(cells, vectors)
    # anchor by anchor the widest window; the windows are nested in it by their upper ends
    hundreds, rest = tops // 100, tops % 100  # so that nothing leaves 64 bits
    floor = mining.low * hundreds - (-mining.low * rest // 100)
    ceiling = mining.high * hundreds + mining.high * rest // 100
    lowest, highest = np.full(len(own), np.iinfo(np.int64).max), np.full(len(own), np.iinfo(np.int64).min)
    np.minimum.at(lowest, slots // mining.positives, floor)
    np.maximum.at(highest, slots // mining.positives, ceiling)
    known = np.full((len(own), mining.positives, 2), [1, 0])  # an empty window where there is no positive
    known[slots // mining.positives, slots % mining.positives] = np.stack([floor, ceiling], 1)
    found: list[Heap] = []
    for begin in range(0, len(ids), mining.strip):
        part = slice(begin, begin + mining.strip)
        scores = strassen(vectors, np.ascontiguousarray(cells[part].T))
        good = (scores >= lowest[:, None]) & (scores <= highest[:, None])
        anchor, place = np.nonzero(good)
        other = own[anchor] != labels[part][place]
        anchor, place = anchor[other], place[other]
        score, id_ = scores[anchor, place], ids[part][place]
        for rank in range(mining.positives):
            low, high = known[anchor, rank].T
            inside = (score >= low) & (score <= high)
            found.append(best(anchor[inside] * mining.positives + rank, score[inside], id_[inside], mining.negatives))
    return merged(found, mining.negatives)


def _heaps(cells: DataFrame, of, most: int, mining: Mining) -> DataFrame:  # noqa: ANN001
    """One heap for each panel: merged inside the tasks, which hold a bounded number of them, and then by the panel."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Heap] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                panel, heap = row["p_number"], of(row, mining)
                held[panel] = merged([held[panel], heap], most) if panel in held else heap
                if len(held) > mining.held:
                    yield from (_heap_row(*x) for x in held.items())
                    held = {}
        yield from (_heap_row(*x) for x in held.items())

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if held is not None and row["panel"] == last:
                    held = merged([held, _heap_of(row)], most)
                    continue
                if held is not None:
                    yield _heap_row(last, held)
                held, last = _heap_of(row), row["panel"]
        if held is not None:
            yield _heap_row(last, held)

    parts = cells.mapInArrow(collect, _HEAP)
    return parts.repartition("panel").sortWithinPartitions("panel").mapInArrow(merge, _HEAP)


_FOUND = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def _rows_of(panels: DataFrame, mining: Mining) -> DataFrame:
    """Result rows of panels with both heaps."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                anchors = np.frombuffer(row["ids"], np.int64)
                slots, tops, positives = _heap_of(row, "h_")
                slot, score, id_ = _heap_of(row, "n_")
                at = np.searchsorted(slots, slot)
                first = np.searchsorted(slot, slot)
                columns = [anchors[slot // mining.positives], positives[at], (np.arange(len(slot)) - first + 1).astype(np.int32), id_, tops[at], score]
                yield pa.record_batch([pa.array(c) for c in columns], [c.split()[0] for c in _FOUND.split(", ")])

    return panels.mapInArrow(rows, _FOUND)


def _ranked(heap: Heap, most: int) -> Heap:
    """Slots of anchors become slots of their positives."""
    slot, score, id_ = heap
    return slot * most + np.arange(len(slot)) - np.searchsorted(slot, slot), score, id_


def mined(rows: DataFrame, is_anchor: Column, mining: Mining | None = None) -> DataFrame:
    """Hard negatives of the anchors among rows of (id bigint, label bigint, vector array<bigint>)."""
    mining = mining or Mining()
    spark = rows.sparkSession
    rows = rows.where("id is not null and label is not null and vector is not null").select("id", "label", "vector").distinct()
    tiles = staged(_pack(rows, mining.tile), "tiles")
    anchors = rows.where(is_anchor)
    blocks = max(1, -(-anchors.count() // (mining.panel * mining.panels)))
    panels = staged(_pack(anchors.repartition(blocks, "id"), mining.panel), "panels")
    lanes = max(1, tiles.count())
    heaps = _heaps(_cells(tiles, panels, blocks, lanes), _positives, mining.positives, mining)

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield _heap_row(row["panel"], _ranked(_heap_of(row), mining.positives))

    heaps = heaps.mapInArrow(rank, _HEAP).select(F.col("panel").alias("number"), *(F.col(c).alias(f"h_{c}") for c in ("slots", "scores", "ids")))
    panels = staged(panels.join(heaps, "number"), "positives")
    cells = _cells(tiles, panels, blocks, lanes)
    cells = cells.select(*[F.col(c).alias(c.removeprefix("p_") if c.startswith("p_h_") else c) for c in cells.columns])
    found = _heaps(cells, _negatives, mining.negatives, mining)
    found = found.select(F.col("panel").alias("number"), *(F.col(c).alias(f"n_{c}") for c in ("slots", "scores", "ids")))
    return _rows_of(panels.select("number", "ids", "h_slots", "h_scores", "h_ids").join(found, "number"), mining)


def scaled(vector: str, factor: int = 256) -> str:
    """Components as integers (SQL text): floor of the factor times each; null where one is null or not finite."""
    finite = f"forall({vector}, x -> coalesce(not isnan(x) and abs(cast(x as double)) < double('infinity'), false))"
    fits = f"forall({vector}, x -> abs({factor} * cast(x as double)) < 9.2e18)"
    whole = f"transform({vector}, x -> floor({factor} * cast(x as double)))"
    return f"case when {finite} then if({fits}, {whole}, raise_error('a component does not fit 64 bits')) end"


def hard_negatives(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
                   anchors: int = 100, relabelled: int = 7, labels: int = 10, mining: Mining | None = None) -> DataFrame:
    """Anchors are the rows whose id is divisible by `anchors`; rows whose id is divisible by `relabelled` first get the
    next label, so that some labels are wrong."""
    label = f"cast(`{label_column}` as bigint)"
    rows = vectors.selectExpr(
        f"cast(`{id_column}` as bigint) as id",
        f"if(cast(`{id_column}` as bigint) % {relabelled} = 0, ({label} + 1) % {labels}, {label}) as label",
        f"{scaled(f'`{vector_column}`')} as vector",
    )
    return mined(rows, F.col("id") % anchors == 0, mining)
