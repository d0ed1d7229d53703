"""Near-duplicate documents by weighted minwise hashing with darts.

A text is its set of five-word shingles (lower case, words between white space), each a weighted
element. Every element's (weight, rank) plane is cut into unit regions; hashing throws a Poisson
number of darts into each region, the same ones in every document, and each dart carries a
coordinate. A document looks at the regions below its weights, at as many ranks as give it some
``k ln k`` darts, and keeps the earliest dart of each of ``k`` coordinates. Work grows with the
number of elements plus the number of darts, not with their product.

Two documents agree in a coordinate with the probability of their weighted Jaccard similarity.
``BANDS`` bands of ``ROWS`` coordinates each meet in a join; a pair at similarity 0.8 misses all
of them once in some 20,000 times. Candidates are then checked exactly on their shingle sets.

Groups of any size stay cheap, and no link between different sets is lost among candidates:
equal sets become one representative first; in a bucket each member is checked against its hub only,
the member that meets most others in all of its buckets; and where a bucket still joins documents of different components, their pairs
are searched through the rarest fifth of their shingles, across components only: two sets of
similarity 0.8 must share one of these, with enough after it in both. Copies that differ from a hub
too much to be linked to it have too many shingles of their own in front to meet each other.

Defined results: a text of one to four words is one shingle. A null text, or one without a word,
belongs to no group: its class is its own id. Rows with a null id join their copies' class, or
none (null). Repeated rows share a class. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType, LongType
from xxhash import xxh3_64_intdigest

from emberlink.llm.common import cut_lineage, fresh, table
from emberlink.llm.components import connected_components
from emberlink.llm.memo import ENTRY_BYTES

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 25, 5
COORDINATES = BANDS * ROWS
REMEMBERED_BYTES = 32_000_000  # of distinct words a task keeps; beyond that it starts anew, with the same results
REGIONS = 1 << 18  # unit regions into which darts are thrown at once
_DARTS = COORDINATES * (np.log(COORDINATES) + 3)  # expected darts that leave few coordinates empty
_POISSON = np.cumsum([np.exp(-1.0) / np.prod(np.arange(1.0, i + 1)) for i in range(20)])
_SALT = [int(x) for x in np.random.default_rng(5).integers(1, 2**63, 64, dtype=np.uint64) | 1]


def mix(x: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit hash of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ np.uint64(salt)) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(32))


class Shingler:
    """Hashes of the distinct five-word shingles of texts."""

    def __init__(self) -> None:
        self.words: dict[str, int] = {}
        self.size = 0

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.lower().split() if text else []
        known = self.words
        try:
            h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            if self.size > REMEMBERED_BYTES:
                known.clear()
                self.size = 0
            new = set(words).difference(known)
            known.update((w, xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))) for w in new)
            self.size += (ENTRY_BYTES + 32) * len(new) + sum(map(len, new))
            h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        if not len(h):
            return h
        n = max(1, len(h) - WORDS + 1)
        with np.errstate(over="ignore"):
            total = np.full(n, len(h) if len(h) < WORDS else WORDS, np.uint64)
            for i in range(min(WORDS, len(h))):
                total += mix(h[i : i + n], _SALT[i])
        return np.unique(mix(total, _SALT[10]))


def _throw(elements: np.ndarray, slab: np.ndarray, limit: np.ndarray, owner: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Darts of unit regions: slot (owner and coordinate) and packed (rank, identity).

    A region is one unit slab of an element's weight and one unit block of ranks. ``limit`` is
    how much of the slab the element's weight covers.
    """
    region = mix(elements ^ mix(slab << np.uint64(32) | block, _SALT[11]), _SALT[12])
    count = np.searchsorted(_POISSON, (region >> np.uint64(11)).astype(np.float64) / 2**53)
    which = np.repeat(np.arange(len(region)), count)
    number = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    dart = mix(region[which] + number.astype(np.uint64) * np.uint64(_SALT[13]), _SALT[14])
    if (limit < 1).any():
        height = (mix(dart, _SALT[15]) >> np.uint64(11)).astype(np.float64) / 2**53
        hit = height < limit[which]
        which, dart = which[hit], dart[hit]
    coordinate = mix(dart, _SALT[16]) % np.uint64(COORDINATES)
    slot = owner[which] * COORDINATES + coordinate.astype(np.int64)
    # 16 bits of block, then 48 of the dart: its first 24 are the rank within the block.
    return slot, block[which] << np.uint64(48) | dart >> np.uint64(16)


def signatures(sets: list[np.ndarray], weights: list[np.ndarray] | None = None) -> np.ndarray:
    """The earliest dart of each coordinate, one row a set; all sets must hold an element."""
    if not sets:
        return np.zeros((0, COORDINATES), np.uint64)
    elements = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    slab, limit = np.zeros(len(elements), np.uint64), np.ones(len(elements))
    if weights is not None:
        heavy = np.concatenate(weights).astype(np.float64)
        layers = np.ceil(heavy).astype(np.int64)
        first = np.repeat(np.cumsum(layers) - layers, layers)
        level = np.arange(layers.sum()) - first
        elements, owner, slab = np.repeat(elements, layers), np.repeat(owner, layers), level.astype(np.uint64)
        limit = np.minimum(1.0, np.repeat(heavy, layers) - level)
    mass = np.bincount(owner, weights=limit, minlength=len(sets))
    best = np.full(len(sets) * COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    done, upto = np.zeros(len(sets), np.int64), np.ceil(_DARTS / mass).astype(np.int64)
    while True:
        blocks = (upto - done)[owner]
        behind = np.cumsum(blocks)
        # So many regions at a time, however large the sets are.
        for start in range(0, int(behind[-1]), REGIONS):
            region = np.arange(start, min(start + REGIONS, int(behind[-1])))
            which = np.searchsorted(behind, region, side="right")
            block = (region - (behind - blocks)[which] + done[owner[which]]).astype(np.uint64)
            slot, packed = _throw(elements[which], slab[which], limit[which], owner[which], block)
            np.minimum.at(best, slot, packed)
        empty = (best.reshape(len(sets), -1) == np.iinfo(np.uint64).max).any(axis=1)
        if not empty.any():
            return best.reshape(len(sets), -1)
        # Too few darts for some: look at as many ranks again.
        done = upto
        upto = np.where(empty, 2 * upto, upto)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each signature."""
    parts = signature.reshape(len(signature), BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2]).copy()
    for i in range(ROWS):
        key = mix(key ^ parts[:, :, i], _SALT[20 + i])
    return key.view(np.int64)


def sign(docs: DataFrame, key_cols: list[str]) -> DataFrame:
    """``key_cols`` with each text's set key (``s1``, ``s2``), its size ``n`` and its band keys."""

    def signed(part: pd.DataFrame, sets: list[np.ndarray]) -> pd.DataFrame:
        full = [i for i, s in enumerate(sets) if len(s)]
        bands = [None] * len(sets)
        for i, keys in zip(full, band_keys(signatures([sets[i] for i in full]))):
            bands[i] = keys
        with np.errstate(over="ignore"):
            sums = [[int(mix(s, salt).sum().view(np.int64)) for s in sets] for salt in _SALT[30:32]]
        return part[key_cols].assign(s1=sums[0], s2=sums[1], n=[len(s) for s in sets], bands=bands)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingler()
        for batch in batches:
            sets, regions, start = [], 0, 0
            for i, text in enumerate(batch["text"]):
                sets.append(shingles(text))
                regions += max(len(sets[-1]), int(_DARTS))  # a small set takes as many darts as a large one
                if regions >= REGIONS:
                    yield signed(batch.iloc[start : i + 1], sets)
                    sets, regions, start = [], 0, i + 1
            if sets:
                yield signed(batch.iloc[start:], sets)

    kept = docs.select(*key_cols, "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name in key_cols)
    return kept.mapInPandas(work, f"{schema}, s1 long, s2 long, n int, bands array<long>")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of pairs (``a``, ``b``), those whose shingle sets have the similarity asked for."""
    side = lambda c: sets.select(F.col("id").alias(c), F.col("shingles").alias(f"{c}_set"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    common = F.size(F.array_intersect("a_set", "b_set"))
    return both.where(common >= SIMILARITY * (F.size("a_set") + F.size("b_set") - common)).select("a", "b")


def _like_sized(a: str, b: str) -> Column:
    """Whether two sets of these sizes can have the similarity asked for."""
    return F.least(a, b) >= SIMILARITY * F.greatest(a, b)


def _across(shared: DataFrame, components: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (``a``, ``b``: components) between documents of different components that share a bucket.

    Where a bucket holds several components, all of its documents are searched together: a set's
    rarest ``n - ceil(0.8 n) + 1`` shingles must hold one of any set that is similar to it.
    """
    labelled = shared.join(components.withColumnRenamed("node", "id"), "id", "left").withColumn("part", F.coalesce("component", "id"))
    mixed = labelled.groupBy("bucket").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi").select("bucket")
    open_docs = cut_lineage(labelled.join(mixed, "bucket").select("id", "part", "n").distinct(), "darts-open")
    each = open_docs.join(sets, "id").select("id", "part", "n", F.explode("shingles").alias("shingle"))
    seen = each.groupBy("shingle").agg(F.count("*").alias("df"))
    ordered = each.join(seen, "shingle").groupBy("id", "part", "n").agg(F.array_sort(F.collect_list(F.struct("df", "shingle"))).alias("by_df"))
    prefix = F.slice("by_df", 1, (F.col("n") - F.ceil(F.lit(SIMILARITY) * F.col("n")) + 1).cast("int"))
    rare = ordered.select("id", "part", "n", F.posexplode(prefix).alias("at", "s")).where("s.df > 1")
    rare = cut_lineage(rare.select("id", "part", "n", (F.col("n") - F.col("at")).alias("rest"), "s.shingle"), "darts-rare")
    other = rare.select("shingle", F.col("id").alias("b"), F.col("part").alias("part_b"), F.col("n").alias("n_b"), F.col("rest").alias("rest_b"))
    # Two sets whose first common shingle this is have no more in common than what comes after it in either.
    enough = F.least("rest", "rest_b") * (1 + SIMILARITY) >= SIMILARITY * (F.col("n") + F.col("n_b")) - 1e-6
    pairs = rare.withColumnRenamed("id", "a").join(other, "shingle").where(F.expr("a < b and part <> part_b") & _like_sized("n", "n_b") & enough)
    checked = _verified(pairs.select("a", "b").distinct(), sets)
    part_of = lambda c: open_docs.select(F.col("id").alias(c), F.col("part").alias(f"part_{c}"))
    return checked.join(part_of("a"), "a").join(part_of("b"), "b").select(F.col("part_a").alias("a"), F.col("part_b").alias("b"))


@F.pandas_udf(ArrayType(LongType()))
def _shingle_sets(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    shingles = Shingler()
    for batch in batches:
        yield pd.Series([shingles(t).view(np.int64) for t in batch])


def classes(docs: DataFrame) -> DataFrame:
    """(``doc_id``, ``text_key``, ``class_id``) for each row of ``docs`` (``doc_id``, ``text``).

    ``class_id`` is the smallest ``doc_id`` that chains of similar texts lead to; ``text_key`` is
    ``xxhash64(text)``, for finding the row again. Rows that share an id count as one document.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    signed = cut_lineage(sign(rows, ["doc_id", "text_key"]), "darts-signed")
    set_key = ["s1", "s2", "n"]
    first_row = F.min(F.struct("doc_id", "text_key"))
    known = signed.where("n > 0 and doc_id is not null")
    reps = known.groupBy(*set_key).agg(first_row.alias("row"), F.first("bands").alias("bands"))
    reps = cut_lineage(reps.select(*set_key, F.col("row.doc_id").alias("id"), "row.text_key", "bands"), "darts-sets")

    # A row for each band; who is alone in a bucket has no partner there.
    banded = reps.select("id", "text_key", "n", F.explode("bands").alias("bucket"))
    sizes = banded.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    crowded = cut_lineage(banded.join(cut_lineage(sizes, "darts-sizes"), "bucket"), "darts-crowded")
    # The hub of a bucket is the one that meets most others in all of its buckets: among copies that
    # differ here and there, the one that differs least.
    known_by = crowded.groupBy("id").agg(F.sum("members").alias("met"))
    ranked = crowded.join(cut_lineage(known_by, "darts-met"), "id")
    hubs = ranked.groupBy("bucket").agg(F.max(F.struct("met", (-F.col("id")).alias("less"))).alias("top"))
    hubs = cut_lineage(hubs.select("bucket", (-F.col("top.less")).alias("hub")), "darts-hubs")
    shared = cut_lineage(crowded.drop("members").join(hubs, "bucket"), "darts-buckets")

    wanted = shared.select(F.col("id").alias("doc_id"), "text_key").distinct()
    texts = rows.join(wanted, ["doc_id", "text_key"]).groupBy("doc_id", "text_key").agg(F.first("text").alias("text"))
    sets = cut_lineage(texts.select(F.col("doc_id").alias("id"), _shingle_sets("text").alias("shingles")), "darts-shingles")

    of_hub = shared.where("id = hub").select("bucket", F.col("n").alias("hub_n"))
    starred = shared.where("id <> hub").join(of_hub, "bucket").where(_like_sized("n", "hub_n"))
    links = _verified(starred.select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct(), sets)
    first = cut_lineage(connected_components(links, "darts-star"), "darts-classes")
    second = connected_components(_across(shared, first, sets), "darts-across")

    found = (
        reps.select(*set_key, "id")
        .join(first.select(F.col("node").alias("id"), F.col("component").alias("near")), "id", "left")
        .withColumn("near", F.coalesce("near", "id"))
        .join(second.select(F.col("node").alias("near"), F.col("component").alias("far")), "near", "left")
        .select(*set_key, F.coalesce("far", "near").alias("found"))
    )
    judged = signed.select("doc_id", "text_key", *set_key).join(found, set_key, "left")
    return judged.select("doc_id", "text_key", F.when(F.col("n") > 0, F.col("found")).otherwise(F.col("doc_id")).alias("class_id"))


def keep_first(docs: DataFrame) -> DataFrame:
    """A filter: one document of each class, the one with the smallest id, with the columns it came with.

    Of repeated rows one stays. Rows with a null id stay.
    """
    key, turn = fresh(docs.columns, "text_key"), fresh(docs.columns, "turn")
    firsts = classes(docs).where("doc_id = class_id").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    keyed = docs.withColumn(key, F.xxhash64("text"))
    same = Window.partitionBy("doc_id", key).orderBy(F.lit(1))
    once = keyed.where("doc_id is not null").withColumn(turn, F.row_number().over(same)).where(F.col(turn) == 1).drop(turn)
    kept = once.join(firsts, (F.col("doc_id") == F.col("_id")) & (F.col(key) == F.col("_key")), "left_semi")
    return kept.unionByName(keyed.where("doc_id is null")).select(*docs.columns)


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every document: five-word shingles, similarity 0.8 or more."""
    return classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


OP7_SQL = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '\s+'), lambda x: x <> '') AS w FROM documents
),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) BETWEEN 1 AND 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g
  FROM t WHERE len(w) > 0
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
sets AS (SELECT doc_id, n, md5(string_agg(g, '|' ORDER BY g)) AS k FROM s JOIN n USING (doc_id) GROUP BY doc_id, n),
reps AS (SELECT min(doc_id) AS doc_id, any_value(n) AS n, k FROM sets GROUP BY k),
r AS (SELECT doc_id, g FROM s SEMI JOIN reps USING (doc_id)),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM r AS x JOIN r AS y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
linked AS (
  SELECT a, b FROM common JOIN reps AS p ON p.doc_id = a JOIN reps AS q ON q.doc_id = b WHERE c >= 0.8 * (p.n + q.n - c)
),
both_ways AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
reach AS (SELECT a AS node, a AS seen FROM both_ways UNION SELECT reach.node, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.seen),
part AS (SELECT node, min(seen) AS least FROM reach GROUP BY node)
SELECT t.doc_id, coalesce(part.least, reps.doc_id, t.doc_id) AS class_id
FROM t LEFT JOIN sets USING (doc_id) LEFT JOIN reps ON reps.k = sets.k LEFT JOIN part ON part.node = reps.doc_id
"""
