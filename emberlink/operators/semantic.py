"""Semantic link: the event whose vector is closest to an article's by cosine.

Small event sets travel to the tasks as one matrix, behind a check of their size. Beyond that both
sides are cut into blocks, written once, and every pair of blocks is one matrix product. A task reads some
event blocks and some article blocks and leaves one row per article: its best event of those. The best of these is
the answer, so both ways give the same rows. Events with equal vectors are one event there, the first. Every article meets every event, but not with all of its components: events are turned to their
principal axes, products are taken over the first few, and what the others can add is bounded by the
lengths they have left (Cauchy-Schwarz). Only pairs whose bound reaches the best exact product so far are
compared in full. Where a quarter of the axes does not hold most of the events' squares, articles go in groups of some
``_GROUP`` that are near each other: the events' products with the middle of a group, and how far its articles are from there,
bound what an event can reach. Only events that may win for one of ``_FEW`` articles, equally hard to bound, are multiplied with these, first in
single precision; what is within its error of the best is multiplied again in double. Articles that are not near each other meet every event.
No block is copied or shuffled to meet the others: tasks read them where they were written, so what goes to disk is
each vector once and, for each article, one row for each of at most as many event groups as there are cores.
A task holds one event block, and its share of the article blocks; what an article has found in one event block bounds the next.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from emberlink import lexicons as lx
from emberlink.operators.classify import priority_flag
from emberlink.session import cut_lineage

MAX_BROADCAST_BYTES = 128 << 20
BLOCK_ROWS = 8192
_BLOCKS = 64  # blocks grow up to BLOCK_ROWS as long as there are so many
# Equal vectors must tie whatever the order of summation was.
_DIGITS = 12
_CELLS = 1 << 21
_HELD = 0.9  # of the events' squares, by the axes that products are first taken over
_SLACK = 1e-9  # for what rounding does to a bound
_BLOCK_BYTES = 8 << 20  # of a block of single precision that has more than BLOCK_ROWS rows
_GROUP = 256  # articles near one middle, on average
_FEW = 32  # of them that are multiplied together
_STARS = 16  # events nearest to a middle, with which its articles begin
_TURNS = 4  # of moving the middles of groups


def link_semantic(
    articles: DataFrame,
    events: DataFrame,
    threshold: float | None = lx.SEMANTIC_THRESHOLD,
    order: str | Column = "event_id",
    text: str | None = None,
    priority_places: Iterable[str] = lx.PRIORITY_PLACES,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    **options,
) -> DataFrame:
    """Score, event and type for every article whose best event reaches ``threshold``.

    ``articles``: article_id, vector and, for the priority flag, the ``text`` column.
    ``events``: event_id, disaster_type, vector and ``order``, which decides ties.
    A threshold of None keeps the best event of every article.
    """
    best = top1(articles, events, threshold, order, max_broadcast_bytes, **options)
    linked = best.select(
        "article_id",
        F.round("similarity", 4).alias("semantic_score"),
        F.col("event_id").alias("semantic_linked_disaster_id"),
        F.coalesce("disaster_type", F.lit(lx.LANDSLIDE)).alias("linked_disaster_type"),
    )
    if text is None:
        return linked
    # The flag is found where the text is; only a bit per article goes through the join.
    flag = priority_flag(F.col(text), F.lit(True), priority_places).alias("priority_match")
    return linked.join(articles.select("article_id", flag), "article_id", "left")


def usable(vector: str) -> Column:
    """Whether a vector is there, and all of its components are finite numbers."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & whole, F.lit(False))


def left_out(vectors: DataFrame, width: int, vector: str = "vector") -> DataFrame:
    """Rows that :func:`top1` leaves out, with the ``reason``: ``missing``, ``not finite`` or ``width``."""
    reason = (
        F.when(F.col(vector).isNull() | (F.size(vector) == 0), "missing")
        .when(~usable(vector), "not finite")
        .when(F.size(vector) != width, "width")
    )
    return vectors.withColumn("reason", reason).where("reason is not null")


def top1(
    articles: DataFrame,
    events: DataFrame,
    threshold: float | None = None,
    order: str | Column = "event_id",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    block_rows: int = BLOCK_ROWS,
    products: tuple | None = None,
) -> DataFrame:
    """``(article_id, similarity, event_id, disaster_type)``; lowest ``order`` wins ties.

    Articles whose best similarity is below ``threshold`` are left out, and so are vectors that are
    missing, hold a null or a number that is not finite, or are not as wide as most events' (see :func:`left_out`).

    ``products`` may hold two accumulators: for pairs, and for those of them that were compared in full.
    """
    order = F.col(order) if isinstance(order, str) else order
    a = articles.select("article_id", _numbers(articles).alias("vector")).where(usable("vector"))
    e = events.select(
        order.alias("ord"),
        "event_id",
        F.col("disaster_type").cast("string").alias("disaster_type"),
        _numbers(events).alias("vector"),
    ).where(usable("vector"))
    names = F.coalesce(F.length(F.col("ord").cast("string")), F.lit(0)) + F.coalesce(F.length(F.col("event_id").cast("string")), F.lit(0))
    widths = e.groupBy(F.size("vector").alias("width")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(4 * (names + F.coalesce(F.length("disaster_type"), F.lit(0)))).alias("texts")
    )
    # The width that most events have, the larger of equals; vectors of another width compare with nothing.
    top = widths.orderBy(F.desc("n"), F.desc("width")).first()
    if top is None:
        return a.sparkSession.createDataFrame([], _result_schema(a, e)).select("article_id", "similarity", "event_id", "disaster_type")
    width, count = top["width"], top["n"]
    a, e = (side.where(F.size("vector") == width) for side in (a, e))
    if count * (width * 8 + 64) + top["texts"] <= max_broadcast_bytes:
        best = _top1_broadcast(a, e, products)
    else:
        best = _top1_blocks(a, e, width, count, block_rows, products)
    if threshold is not None:
        best = best.where(F.col("similarity") >= F.lit(float(threshold)))
    return best.select("article_id", "similarity", "event_id", "disaster_type")


def _numbers(df: DataFrame) -> Column:
    """The vector as doubles; floats stay floats, at half the size, and become doubles where they are multiplied."""
    kind = df.schema["vector"].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    return F.col("vector") if single else F.col("vector").cast("array<double>")


def _result_schema(a: DataFrame, e: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("article_id", a.schema["article_id"].dataType),
            T.StructField("similarity", T.DoubleType()),
            T.StructField("ord", e.schema["ord"].dataType),
            T.StructField("event_id", e.schema["event_id"].dataType),
            T.StructField("disaster_type", T.StringType()),
        ]
    )


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of an Arrow list column, scaled to length one; a zero row stays zero."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    return _unit(vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1))


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64, copy=False)
    norms = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.where(norms == 0.0, 1.0, norms)


class Axes:
    """Unit vectors turned to their principal axes: the first few components, and the length of the rest.

    Also the vectors in single precision, their mean, and how far each is from it.
    """

    def __init__(self, others: np.ndarray) -> None:
        squares, turn = np.linalg.eigh(others.T @ others)
        squares, turn = np.maximum(squares[::-1], 0.0), turn[:, ::-1]
        held = np.cumsum(squares) / max(squares.sum(), 1e-300)
        self.few = int(np.searchsorted(held, _HELD)) + 1
        self.worth = 4 * self.few <= others.shape[1]
        self.turn = np.ascontiguousarray(turn[:, : self.few])
        self.head, self.rest = self.of(others) if self.worth else (None, None)
        if not self.worth:
            self.single = others.astype(np.float32)
            self.middle = others.mean(axis=0) if len(others) else np.zeros(others.shape[1])
            self.reach = np.linalg.norm(others - self.middle, axis=1).astype(np.float32)

    def of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        head = rows @ self.turn
        return head, np.sqrt(np.maximum((rows * rows).sum(axis=1) - (head * head).sum(axis=1), 0.0))


def _first_best(sims: np.ndarray, left: int, best: np.ndarray, where: np.ndarray) -> None:
    """Take over, in place, what a tile of products has that is better."""
    at = sims.argmax(axis=1)
    value = sims[np.arange(len(at)), at]
    better = value > best
    best[better], where[better] = value[better], at[better] + left


def _best(
    rows: np.ndarray, others: np.ndarray, axes: Axes | None = None, cuts: np.ndarray | None = None, floor: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, int]:
    """Highest cosine per row, the first position that has it, and how many products were taken in full; in bounded memory.

    ``cuts``: where groups of rows that are near each other begin, if they are in that order already. A row whose highest
    cosine is below its ``floor`` may get a lower one.
    """
    if axes is not None and not axes.worth and len(rows) and len(others):
        if cuts is not None:
            return _best_by_groups(rows, others, axes, cuts, floor)
        order, cuts = _groups(rows)
        found = _best_by_groups(rows[order], others, axes, cuts, None if floor is None else floor[order])
        back = np.argsort(order)
        return found[0][back], found[1][back], found[2]
    best = np.full(len(rows), -np.inf)
    where = np.zeros(len(rows), dtype=np.int64)
    width = min(len(others), 4096)
    height = max(1, _CELLS // width)
    taken = 0
    pruned = axes is not None and axes.worth and len(rows)
    head, rest = axes.of(rows) if pruned else (None, None)
    for top in range(0, len(rows), height):
        part = slice(top, top + height)
        for left in range(0, len(others), width):
            some = slice(left, left + width)
            if pruned:
                near = head[part] @ axes.head[some].T
                likely = near.argmax(axis=1)
                exact = np.round((rows[part] * others[left + likely]).sum(axis=1), _DIGITS)
                bound = near + rest[part][:, None] * axes.rest[some][None, :]
                i, j = np.nonzero(bound >= np.maximum(best[part], exact)[:, None] - _SLACK)
                if len(i) * 10 <= bound.size:
                    sims = np.round(np.einsum("ij,ij->i", rows[part][i], others[some][j]), _DIGITS)
                    order = np.lexsort((j, -sims, i))
                    first = order[np.concatenate([[True], i[order][1:] != i[order][:-1]])] if len(i) else order
                    better = sims[first] > best[part][i[first]]
                    best[top + i[first][better]] = sims[first][better]
                    where[top + i[first][better]] = j[first][better] + left
                    taken += len(i) + len(likely)
                    continue
            sims = np.round(rows[part] @ others[some].T, _DIGITS)
            taken += sims.size
            _first_best(sims, left, best[part], where[part])
    return best, where, taken


def _groups(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of rows that brings near ones together, and where each group begins in it. Any grouping gives the same answers."""
    count = -(-len(rows) // _GROUP)
    single = rows.astype(np.float32)
    # Each middle starts at a row, the likelier the farther that is from those before it; the same ones every time.
    draw, middles = np.random.default_rng(count), single[:count].copy()
    away = np.full(len(rows), np.inf)
    for k in range(1, count):
        away = np.minimum(away, ((single - middles[k - 1]) ** 2).sum(axis=1))
        reached = np.cumsum(away, dtype=np.float64)
        middles[k] = single[min(int(np.searchsorted(reached, draw.random() * reached[-1], side="right")), len(rows) - 1)]
    order, cuts = np.arange(len(rows)), np.zeros(min(len(rows), 1), dtype=np.int64)
    for _ in range(_TURNS if count > 1 else 0):
        half = 0.5 * (middles * middles).sum(axis=1)
        mine = np.empty(len(rows), dtype=np.int64)
        step = max(1, _CELLS // count)
        for top in range(0, len(rows), step):
            mine[top : top + step] = (single[top : top + step] @ middles.T - half).argmax(axis=1)
        order = np.argsort(mine, kind="stable")
        cuts = np.flatnonzero(np.concatenate([[True], np.diff(mine[order]) != 0]))
        middles = np.add.reduceat(single[order], cuts, axis=0) / np.diff(np.append(cuts, len(rows)))[:, None].astype(np.float32)
    return order, cuts


def _best_by_groups(
    rows: np.ndarray, others: np.ndarray, axes: Axes, cuts: np.ndarray, floor: np.ndarray | None
) -> tuple[np.ndarray, np.ndarray, int]:
    """:func:`_best` over rows in groups.

    A row is the middle of its group and a rest. With an event, the rest's product is that with the events' mean, and at most its length times how
    far the event is from the mean.
    """
    sizes = np.diff(np.append(cuts, len(rows)))
    middles = np.add.reduceat(rows, cuts, axis=0) / sizes[:, None]
    rest = rows - np.repeat(middles, sizes, axis=0)
    far = np.sqrt((rest * rest).sum(axis=1))
    lean = rest @ axes.middle
    # What single precision may be wrong by: unit vectors, every term and sum rounded.
    error = 2.0 * (rows.shape[1] + 4) * float(np.finfo(np.float32).eps)
    near, wide = float(axes.reach.min()) - error, float(axes.reach.max()) + error
    single, few = rows.astype(np.float32), middles.astype(np.float32)
    best = np.full(len(rows), -np.inf)
    where = np.zeros(len(rows), dtype=np.int64)
    taken, pairs, held = 0, [], 0

    def settle() -> None:
        """Candidates in double: the highest, and of equals the first."""
        i, j = (np.concatenate(p) for p in zip(*pairs))
        step = _CELLS // 64
        sims = np.concatenate([np.round(np.einsum("ij,ij->i", rows[i[k : k + step]], others[j[k : k + step]]), _DIGITS) for k in range(0, len(i), step)])
        order = np.lexsort((j, -sims, i))
        first = order[np.concatenate([[True], i[order][1:] != i[order][:-1]])]
        _take(best, where, i[first], sims[first], j[first])
        pairs.clear()

    step = max(1, _CELLS // len(others))
    for group, (left, size) in enumerate(zip(cuts, sizes)):
        if group % step == 0:
            products = few[group : group + step] @ axes.single.T
        product = products[group % step]
        part = slice(left, left + size)
        stars = np.sort(np.argpartition(product, -_STARS)[-_STARS:]) if len(product) > _STARS else np.arange(len(product))
        sims = np.round(rows[part] @ others[stars].T, _DIGITS)
        at = sims.argmax(axis=1)
        best[part], where[part] = sims[np.arange(size), at], stars[at]
        level = best[part].copy() if floor is None else np.maximum(best[part], floor[part])
        # What the group's product with an event lacks to the level, if the event is as near to the mean, or as far from it, as any.
        lack = lean[part] - level
        low, high = lack + far[part] * near, lack + far[part] * wide
        order = np.argsort(-high)
        for first in range(0, size, _FEW):
            some = order[first : first + _FEW]
            # The highest of lines is below the chord of its ends.
            slope = (high[some].max() - low[some].max()) / max(wide - near, _SLACK)
            base = low[some].max() - slope * near
            reached = np.flatnonzero(product + np.float32(slope) * axes.reach >= np.float32(-base - _SLACK - 4 * error))
            if 2 * len(reached) > len(others):
                reached = None
            chosen = axes.single if reached is None else axes.single[reached]
            height = max(1, _CELLS // max(len(chosen), 1))
            for top in range(0, len(some), height):
                mine = some[top : top + height]
                tile = single[left + mine] @ chosen.T
                taken += tile.size
                if not tile.size:
                    continue
                least = np.maximum(tile.max(axis=1), level[mine].astype(np.float32)) - np.float32(error)
                i, j = np.nonzero(tile >= least[:, None])
                if len(i) > 64 + tile.size // 10:
                    whole = np.round(rows[left + mine] @ (others if reached is None else others[reached]).T, _DIGITS)
                    j = whole.argmax(axis=1)
                    _take(best, where, left + mine, whole[np.arange(len(j)), j], j if reached is None else reached[j])
                elif len(i):
                    pairs.append((left + mine[i], j if reached is None else reached[j]))
                    held += len(i)
                    if held > _CELLS // 8:
                        settle()
                        held = 0
    if pairs:
        settle()
    return best, where, taken


def _take(best: np.ndarray, where: np.ndarray, at: np.ndarray, sims: np.ndarray, j: np.ndarray) -> None:
    """Take over, in place, what is higher, or as high and earlier; ``at`` names no row twice."""
    better = (sims > best[at]) | ((sims == best[at]) & (j < where[at]))
    best[at[better]], where[at[better]] = sims[better], j[better]


def _answers(ids: pa.Array, best: np.ndarray, where: np.ndarray, events: pa.Table, schema: pa.Schema) -> pa.RecordBatch:
    chosen = events.take(pa.array(where))
    columns = [ids, pa.array(best)] + [
        chosen.column(name).combine_chunks() for name in ("ord", "event_id", "disaster_type")
    ]
    return pa.RecordBatch.from_arrays(
        [column.cast(field.type) for column, field in zip(columns, schema)], schema=schema
    )


def _count(products: tuple | None, pairs: int, taken: int) -> None:
    if products:
        products[0].add(pairs)
        products[1].add(taken)


def _top1_broadcast(a: DataFrame, e: DataFrame, products: tuple | None = None) -> DataFrame:
    spark = a.sparkSession
    schema = _result_schema(a, e)
    table = e.toArrow()  # at most max_broadcast_bytes, checked by the caller
    if table.num_rows == 0:
        return spark.createDataFrame([], schema)
    table = table.take(pc.sort_indices(table, sort_keys=[("ord", "ascending")]))
    matrix = _matrix(table.column("vector"))
    shipped = spark.sparkContext.broadcast((matrix, Axes(matrix), table.drop_columns(["vector"])))
    out = _arrow_schema(schema)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix, axes, names = shipped.value
        for batch in batches:
            if batch.num_rows:
                best, where, taken = _best(_matrix(batch.column("vector")), matrix, axes)
                _count(products, len(best) * len(matrix), taken)
                yield _answers(batch.column("article_id"), best, where, names, out)

    return a.mapInArrow(score, schema)


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _block_schema(df: DataFrame, names: list[str], grouped: bool = False) -> T.StructType:
    binary = ["matrix", "cuts"] if grouped else ["matrix"]
    return T.StructType([T.StructField(n, T.ArrayType(df.schema[n].dataType)) for n in names] + [T.StructField(n, T.BinaryType()) for n in binary])


def _in_blocks(df: DataFrame, names: list[str], rows: int, label: str, once: bool = False, grouped: bool = False) -> DataFrame:
    """One row per block of vectors: ``block`` (a number of its own), an array per column in ``names``, and ``matrix``.

    With ``once``, a vector that equals the one before it is left out. With ``grouped``, near vectors are
    together, and ``cuts`` tells where each group begins.
    """
    pack = _block_schema(df, names, grouped)
    out = _arrow_schema(pack)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []

        def blocks(end: bool) -> Iterator[pa.RecordBatch]:
            """Whole blocks of what is held, and at the end the rest."""
            if not held:
                return
            table, vectors = pa.Table.from_batches([b for b, _ in held]), np.concatenate([v for _, v in held])
            held.clear()
            for start in range(0, len(vectors), rows):
                part, some = table.slice(start, rows), vectors[start : start + rows]
                if len(some) < rows and not end:
                    held.append((part.combine_chunks().to_batches()[0], some.copy()))
                    break
                more = {}
                if grouped:
                    order, cuts = _groups(_unit(some))
                    part, some, more = part.take(pa.array(order)), some[order], {"cuts": cuts.astype(np.int64).tobytes()}
                values = {n: part.column(n).to_pylist() for n in names}
                yield pa.RecordBatch.from_pylist([{**values, "matrix": some.tobytes(), **more}], schema=out)

        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            if once:
                new = np.ones(len(vectors), dtype=bool)
                new[1:] = (vectors[1:] != vectors[:-1]).any(axis=1)
                new[0] = last is None or (vectors[0] != last).any()
                last = vectors[-1].copy()
                batch, vectors = batch.filter(pa.array(new)), vectors[new]
            # Copies, so that a block does not keep the batches it came from.
            held.append((batch.select(names), vectors.copy()))
            if sum(len(v) for _, v in held) >= rows:
                yield from blocks(False)
        yield from blocks(True)

    return cut_lineage(df.select(*names, "vector").mapInArrow(cut, pack).withColumn("block", F.monotonically_increasing_id()), label, free=True)


def _together(out: pa.Schema, names: list[str], rows: int):
    """Neighbouring blocks as one, as long as it has no more than ``rows`` rows."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def one() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            columns = {n: [pa.concat_arrays([c.flatten() for c in table.column(n).chunks])] for n in names}
            row = {n: pa.ListArray.from_arrays([0, len(v[0])], v[0]) for n, v in columns.items()}
            row["matrix"] = pa.array([b"".join(table.column("matrix").to_pylist())], pa.binary())
            row["block"] = table.column("block").slice(0, 1).combine_chunks()
            return pa.RecordBatch.from_arrays([row[f.name].cast(f.type) for f in out], schema=out)

        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.slice(i, 1)
                more = len(block.column(names[0])[0])
                if held and size + more > rows:
                    yield one()
                    held, size = [], 0
                held.append(block)
                size += more
        if held:
            yield one()

    return merge


def _first_of(old: pa.Table, new: pa.Table, best: np.ndarray, more: np.ndarray) -> tuple[pa.Table, np.ndarray]:
    """Row by row the better of two answers; the first event of equals."""
    better = more > best
    for i in np.flatnonzero(more == best).tolist():
        one, other = ([c[i].as_py() for c in t.columns] for t in (old, new))
        better[i] = _before(other, one)
    if not better.any():
        return old, best
    at = np.arange(len(best))
    both = pa.concat_tables([old, new]).take(pa.array(np.where(better, at + len(best), at)))
    return both.combine_chunks(), np.where(better, more, best)


def _before(one: list, other: list) -> bool:
    """Whether an event comes before another; nulls last."""
    for x, y in zip(one, other):
        if x != y:
            return y is None or (x is not None and x < y)
    return False


def _top1_blocks(a: DataFrame, e: DataFrame, width: int, count: int, rows: int, products: tuple | None = None) -> DataFrame:
    spark, schema = a.sparkSession, _result_schema(a, e)
    names = ["ord", "event_id", "disaster_type"]
    kinds = [np.float32 if isinstance(side.schema["vector"].dataType.elementType, T.FloatType) else np.float64 for side in (a, e)]
    rows = max(rows, min(_BLOCK_BYTES // (4 * width), count // _BLOCKS))
    # Equal vectors come together, the first of them in front.
    tasks = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // rows)))
    same = F.xxhash64("vector")
    ordered = e.repartition(tasks, same).sortWithinPartitions(same, *[F.col(n).asc_nulls_last() for n in names])
    events = _in_blocks(ordered, names, rows, "event-blocks", once=True)
    articles = _in_blocks(a, ["article_id"], rows, "article-blocks", grouped=True)
    out = _arrow_schema(schema)
    # Blocks that copies have left small are put together where they are read.
    fewer = events.coalesce(max(1, spark.sparkContext.defaultParallelism)).mapInArrow(
        _together(_arrow_schema(events.schema), names, rows), events.schema
    )
    pairs = fewer.select(F.col("block").alias("e_block"), *names, F.col("matrix").alias("e_matrix")).crossJoin(
        articles.select("block", "article_id", "matrix", "cuts")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        event, found = None, {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i] for n in batch.schema.names}
                if row["e_block"].as_py() != event:
                    event = row["e_block"].as_py()
                    table = pa.table({n: row[n].values.cast(out.field(n).type) for n in names})
                    order = pc.sort_indices(table, sort_keys=[(n, "ascending") for n in names])
                    table = table.take(order)
                    matrix = _unit(np.frombuffer(row["e_matrix"].as_buffer(), kinds[1]).reshape(-1, width)[order.to_numpy()])
                    axes = Axes(matrix)
                no = row["block"].as_py()
                vectors = _unit(np.frombuffer(row["matrix"].as_buffer(), kinds[0]).reshape(-1, width))
                cuts = np.frombuffer(row["cuts"].as_buffer(), np.int64)
                best, where, taken = _best(vectors, matrix, axes, cuts, found[no][2] if no in found else None)
                _count(products, len(best) * len(matrix), taken)
                chosen = table.take(pa.array(where))
                if no in found:
                    ids, old, value = found[no]
                    found[no] = (ids, *_first_of(old, chosen, value, best))
                else:
                    # A copy, so that the batch with its matrices can go.
                    found[no] = (pa.array(row["article_id"].as_py(), out.field(0).type), chosen, best)
        for ids, table, best in found.values():
            columns = [ids, pa.array(best)] + [table.column(n).combine_chunks() for n in names]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, out)], schema=out)

    answers = pairs.mapInArrow(compare, schema)
    key = [f(n) for n in names for f in (lambda n: F.col(n).isNull().alias(f"no_{n}"), F.col)]
    first = F.min(F.struct((-F.col("similarity")).alias("less"), *key)).alias("w")
    return answers.groupBy("article_id").agg(first).select("article_id", (-F.col("w.less")).alias("similarity"), *[f"w.{n}" for n in names])
