"""Removing text that occurs before, by sorting suffixes in front-coded runs.

A byte goes if a 100-byte string covers it that also starts earlier (in a document with a smaller
id, or earlier in its own). Sorting the suffixes at every byte would take many times the input, so
suffixes are sorted at *anchors*: of each window of 100 bytes, the 32-byte gram with the smallest
hash, the first such. Equal windows have equal anchors at equal offsets, so nothing is lost, and a
document has one anchor in some 36 bytes. The windows of one anchor are consecutive; the
bytes that they cover are its *segment*, a suffix from its first window cut off after its last.

1. Anchors whose gram occurs once in the corpus are dropped. Each task sends each gram's hash once,
   as four-byte numbers in a bucket; a clash of hashes keeps an anchor, and costs work only.
2. Segments of the rest are sorted in each task: equal ones collapse to the first, the others are
   repeats and done; the run of different ones goes out front-coded, split into buckets by content. A bucket merges its runs with
   a loser tree over common prefixes; of equal segments all but the first are repeats.
3. Different segments with one gram, the edges of repeated passages, may still share some of their
   windows. These are compared window by window among the first segments of each kind. Grams with
   many kinds are salted, and what is first within each salt meets in one more aggregation.

Hashes choose what to compare and, in step 3 alone, stand for 100-byte strings (64 bits next to the
gram's 64). Rows with one id are ordered by the hash of their text; wholly equal rows with one id
count as one and keep their bytes. Null ids come last.

Defined results: a null text is empty. Texts under 100 bytes have nothing to remove. Text is
compared as UTF-8, so a removal may split a character; :func:`remove` drops the loose bytes where it
makes text again. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from emberlink.llm.common import cut_lineage, fresh, scratch_dir, scratch_scope, table
from emberlink.llm.front_coding import LoserTree, decode_run, encode_run

WINDOW = 100
GRAM = 32
RUN_BYTES = 16_000_000  # of anchors a task holds before it sends a run; of segments, four times that
BUCKET_BYTES = 12_000_000  # of text whose anchors or segments meet in one bucket
KINDS = 256  # different segments of one gram that are compared in one group
_LAST = 2**63 - 1
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(2 * n, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(32))


def rolling(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every substring of ``size`` bytes."""
    if len(data) < size:
        return np.zeros(0, np.uint64)
    up, down = _power(len(data) + 1)
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], dtype=np.uint64)])
        return _mix((total[size:] - total[:-size]) * down[: len(data) - size + 1])


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every anchor: which text it is in, its gram's hash, and its first and last window (as starts).

    The texts are hashed as one piece, and windows that reach across their ends are left out.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begin, windows = np.cumsum(sizes) - sizes, np.maximum(sizes - WINDOW + 1, 0)
    owner = np.repeat(np.arange(len(texts)), windows)
    start = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    if not len(owner):
        return owner, np.zeros(0, np.uint64), start, start
    least, wide = rolling(data, GRAM), WINDOW - GRAM + 1
    at = np.arange(len(least), dtype=np.int32)

    def join(step: int) -> None:
        nonlocal least, at
        left = least[:-step] <= least[step:]
        least, at = np.where(left, least[:-step], least[step:]), np.where(left, at[:-step], at[step:])

    width = 1
    while 2 * width <= wide:
        join(width)
        width *= 2
    if width < wide:
        join(wide - width)
    mine = begin[owner] + start
    least, at = least[mine], at[mine]
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return owner[first], least[first], start[first], start[np.concatenate([first[1:], [len(at)]]) - 1]


def _chunks(batch: pd.DataFrame, size: int = 1 << 16) -> Iterator[tuple[slice, list[bytes]]]:
    """Rows in a row with some 64 kB of text together: as much as a core's cache holds work on."""
    start, held, texts = 0, 0, []
    for i, text in enumerate(batch["text"]):
        texts.append(_bytes(text))
        held += len(texts[-1])
        if held >= size or i + 1 == len(batch):
            yield slice(start, i + 1), texts
            start, held, texts = i + 1, 0, []


def _ordered(docs: DataFrame) -> DataFrame:
    """``k1`` and ``k2``: what orders documents, and ``text``."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("k1"), F.xxhash64("text").alias("k2"), F.col("text"))


def _bytes(text: str | None) -> bytes:
    return text.encode("utf-8") if text else b""


# ---- 1: grams that occur more than once ---------------------------------------------------


def repeated_anchors(docs: DataFrame, buckets: int) -> DataFrame:
    """(``k1``, ``k2``, ``anchor``): numbers of the anchors whose gram occurs elsewhere too."""

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            k1, k2 = batch["k1"].to_numpy(), batch["k2"].to_numpy()
            for rows, texts in _chunks(batch):
                owner, grams, _, _ = anchors(texts)
                number = np.arange(len(owner)) - np.searchsorted(owner, owner)
                held.append((k1[rows][owner], k2[rows][owner], number, grams))
                size += len(grams)
                if size >= RUN_BYTES // 24:
                    yield _anchor_run(held, buckets)
                    held, size = [], 0
        if size:
            yield _anchor_run(held, buckets)

    def meet(runs: pd.DataFrame) -> pd.DataFrame:
        rows = np.concatenate([np.frombuffer(zstandard.decompress(b), "<u4,<i4,<i8,<i8") for b in runs["entries"]])
        once = np.concatenate([np.frombuffer(zstandard.decompress(b), np.uint8) for b in runs["once"]]).astype(bool)
        # A gram a task has met twice is known there; it still speaks to the other tasks.
        _, group, size = np.unique(rows["f0"], return_inverse=True, return_counts=True)
        found = rows[once & (size[group] > 1)]
        return pd.DataFrame({"k1": found["f2"], "k2": found["f3"], "anchor": found["f1"]})

    sent = docs.mapInPandas(send, "bucket int, entries binary, once binary, anchors binary")
    sent = cut_lineage(sent, "suffix-grams", free=True)
    met = sent.where("bucket >= 0").select("bucket", "entries", "once").repartition(buckets, "bucket").groupBy("bucket").applyInPandas(meet, "k1 long, k2 long, anchor int")

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for entries in batch["anchors"]:
                rows = np.frombuffer(zstandard.decompress(entries), "<i8,<i8,<i4")
                yield pd.DataFrame({"k1": rows["f0"], "k2": rows["f1"], "anchor": rows["f2"]})

    known = sent.where("bucket < 0").select("anchors").mapInPandas(spread, "k1 long, k2 long, anchor int")
    return met.unionByName(known)


def _anchor_run(held: list, buckets: int) -> pd.DataFrame:
    """One task's anchors: by bucket, one entry a gram; and those it knows to be repeated."""
    k1, k2, number, grams = (np.concatenate([h[i] for h in held]) for i in range(4))
    rows = np.zeros(len(grams), "<u4,<i4,<i8,<i8")
    rows["f0"], rows["f1"], rows["f2"], rows["f3"] = grams & np.uint64(0xFFFFFFFF), number, k1, k2
    _, first, group, count = np.unique(grams, return_index=True, return_inverse=True, return_counts=True)
    again = count[group] > 1
    known = np.zeros(int(again.sum()), "<i8,<i8,<i4")
    known["f0"], known["f1"], known["f2"] = rows["f2"][again], rows["f3"][again], rows["f1"][again]
    first.sort()
    bucket = ((grams[first] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    out = []
    for b in np.unique(bucket):
        picked = first[bucket == b]
        out.append((int(b), zstandard.compress(rows[picked].tobytes(), 3), zstandard.compress((~again[picked]).astype(np.uint8).tobytes(), 3), None))
    if len(known):
        out.append((-1, None, None, zstandard.compress(known.tobytes(), 3)))
    return pd.DataFrame(out, columns=["bucket", "entries", "once", "anchors"])


# ---- 2: equal segments ------------------------------------------------------------------


def merge_segments(docs: DataFrame, wanted: DataFrame, buckets: int) -> DataFrame:
    """The segments of the anchors ``wanted`` of each document, merged: (``gram``, ``k1``, ``k2``, ``start``, ``size``, ``segment``).

    ``segment`` holds the bytes of the first of its kind. It is null for repeats (whose gram is 0), of which those of one
    task and document that overlap or touch are one.
    """
    texts = docs.join(wanted, ["k1", "k2"])

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Places as plain numbers in a row: tuples of them would take four times the memory.
        held: dict[bytes, array] = {}
        size = 0
        for batch in batches:
            k1, k2, picked = batch["k1"].to_numpy(), batch["k2"].to_numpy(), list(batch["anchors"])
            for rows, texts in _chunks(batch):
                owner, grams, first, last = anchors(texts)
                base = np.searchsorted(owner, np.arange(len(texts)))
                chosen = np.concatenate([b + np.sort(p) for b, p in zip(base, picked[rows])])
                docs_of, c1, c2 = owner[chosen], k1[rows].tolist(), k2[rows].tolist()
                for doc, gram, lo, hi in zip(docs_of.tolist(), grams[chosen].view(np.int64).tolist(), first[chosen].tolist(), last[chosen].tolist()):
                    segment = texts[doc][lo : hi + WINDOW]
                    places = held.get(segment)
                    if places is None:
                        places = held[segment] = array("q")
                        size += len(segment) + 150
                    places.extend((c1[doc], c2[doc], lo, gram))
                    size += 100
                if size >= 4 * RUN_BYTES:
                    run = _segment_run(held, buckets)
                    held, size = {}, 0
                    yield run
        if held:
            run = _segment_run(held, buckets)
            held = {}
            yield run

    sent = texts.mapInPandas(send, "bucket int, run binary, places binary")
    merged = sent.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(_merge_bucket, "gram long, k1 long, k2 long, start int, size int, segment binary")
    return cut_lineage(merged, "suffix-segments", free=True)


_PLACE = np.dtype("<i8,<i8,<i8,<i4")  # k1, k2, gram, start
_REPEAT = np.dtype("<i8,<i8,<i4,<i4")  # k1, k2, start, size
_PIECE = 50_000  # repeats that travel together


def _joined(rows: np.ndarray) -> np.ndarray:
    """Repeats by document and place; those of a document that overlap or touch become one."""
    if not len(rows):
        return rows
    rows = rows[np.lexsort((rows["f2"], rows["f1"], rows["f0"]))]
    new_doc = (rows["f0"][1:] != rows["f0"][:-1]) | (rows["f1"][1:] != rows["f1"][:-1])
    # One line for all documents, on which each has room for more than a text can hold.
    begin = (np.concatenate([[0], np.cumsum(new_doc)]) << 33) + rows["f2"]
    reach = np.maximum.accumulate(begin + rows["f3"])
    head = np.flatnonzero(np.concatenate([[True], begin[1:] > reach[:-1]]))
    out = rows[head]
    out["f3"] = reach[np.concatenate([head[1:], [len(rows)]]) - 1] - begin[head]
    return out


def _segment_run(held: Mapping[bytes, Sequence], buckets: int) -> pd.DataFrame:
    """One task's segments (with ``k1``, ``k2``, ``start`` and ``gram`` of each place), sorted and front-coded by bucket,
    each with its first place.

    The other places are repeats whatever other tasks hold. They meet nobody: they are joined within
    their document and go out in pieces dealt evenly over buckets of their own.
    """
    parts: dict[int, list[bytes]] = defaultdict(list)
    for segment in held:
        parts[zlib.crc32(segment) % buckets].append(segment)
    out, repeats = [], [np.zeros(0, _REPEAT)]
    while parts:
        bucket, strings = parts.popitem()
        strings.sort()
        flat = [np.asarray(held[s], np.int64).reshape(-1, 4) for s in strings]
        owner = np.repeat(np.arange(len(strings)), [len(f) for f in flat])
        k1, k2, start, gram = np.concatenate(flat).T
        order = np.lexsort((gram, start, k2, k1, owner))
        owner, k1, k2, start, gram = (x[order] for x in (owner, k1, k2, start, gram))
        head = np.concatenate([[True], owner[1:] != owner[:-1]])
        first = np.zeros(len(strings), _PLACE)
        for name, column in zip(_PLACE.names, (k1, k2, gram, start)):
            first[name] = column[head]
        again = np.zeros(int((~head).sum()), _REPEAT)
        for name, column in zip(_REPEAT.names, (k1, k2, start, np.fromiter(map(len, strings), np.int64, len(strings))[owner])):
            again[name] = column[~head]
        repeats.append(again)
        out.append((bucket, encode_run(strings), zstandard.compress(first.tobytes(), 3)))
    rest = _joined(np.concatenate(repeats))
    for at in range(0, len(rest), _PIECE):
        piece = zstandard.compress(rest[at : at + _PIECE].tobytes(), 3)
        out.append((buckets + zlib.crc32(piece) % buckets, None, piece))
    return pd.DataFrame(out, columns=["bucket", "run", "places"])


def _merge_bucket(runs: pd.DataFrame) -> pd.DataFrame:
    """Merge the runs of one bucket, where equal strings come out in a row; or unpack its repeats."""
    columns = ["gram", "k1", "k2", "start", "size", "segment"]
    if runs["run"].isna().all():
        rows = np.concatenate([np.frombuffer(zstandard.decompress(b), _REPEAT) for b in runs["places"]])
        return pd.DataFrame({"gram": 0, "k1": rows["f0"], "k2": rows["f1"], "start": rows["f2"], "size": rows["f3"], "segment": None}, columns=columns)
    tree = LoserTree([decode_run(r) for r in runs["run"]])
    firsts = [np.frombuffer(zstandard.decompress(b), _PLACE).tolist() for b in runs["places"]]
    out, again, kind, places, gram = [], [], None, [], 0

    def close() -> None:
        if kind is not None:
            best = min(places)
            out.append((gram, *best, len(kind), kind))
            again.extend((*p, len(kind)) for p in places if p != best)

    for run, at, string, shared in tree:
        if kind is None or shared < len(string) or len(string) != len(kind):
            close()
            kind, places = string, []
        k1, k2, gram, start = firsts[run][at]
        places.append((k1, k2, start))
    close()
    out.extend((0, *p, None) for p in _joined(np.array(again, _REPEAT)).tolist())
    return pd.DataFrame(out, columns=columns)


# ---- 3: windows that different segments share -----------------------------------------


_WINDOW_COLUMNS = ["k1", "k2", "start", "stop", "gram", "window", "open"]
_TOGETHER = 1_000_000  # bytes of segments whose windows are sorted at once


def _compare_windows(rows: pd.DataFrame) -> pd.DataFrame:
    """Repeated windows of whole groups (``gram``, ``salt``) of segments, as intervals.

    Of salted groups, also the first of each window (``open``), for comparison between salts.
    """
    texts = list(rows["segment"])
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    windows = sizes - WINDOW + 1
    owner = np.repeat(np.arange(len(texts)), windows)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    hashes = rolling(np.frombuffer(b"".join(texts), np.uint8), WINDOW)[(np.cumsum(sizes) - sizes)[owner] + inner].view(np.int64)
    gram, salt, many, k1, k2 = (rows[c].to_numpy()[owner] for c in ("gram", "salt", "salted", "k1", "k2"))
    start = rows["start"].to_numpy()[owner].astype(np.int64) + inner
    order = np.lexsort((start, k2, k1, hashes, salt, gram))
    g, sa, h, a, b, at = (x[order] for x in (gram, salt, hashes, k1, k2, start))
    head = np.concatenate([[True], (g[1:] != g[:-1]) | (sa[1:] != sa[:-1]) | (h[1:] != h[:-1])])
    lead = np.flatnonzero(head)[np.cumsum(head) - 1]
    later = np.sort(order[(a != a[lead]) | (b != b[lead]) | (at != at[lead])])
    # Windows of one segment that follow each other are one interval.
    begins = np.flatnonzero(np.concatenate([[True], (owner[later][1:] != owner[later][:-1]) | (later[1:] != later[:-1] + 1)])) if len(later) else later
    ends = np.concatenate([begins[1:], [len(later)]])[: len(begins)] - 1
    lo, hi = later[begins], later[ends]
    spans = {"k1": k1[lo], "k2": k2[lo], "start": start[lo], "stop": start[hi] + WINDOW, "gram": 0, "window": 0, "open": False}
    f = order[head & many[order]]
    firsts = {"k1": k1[f], "k2": k2[f], "start": start[f], "stop": 0, "gram": gram[f], "window": hashes[f], "open": True}
    return pd.concat([pd.DataFrame(x, columns=_WINDOW_COLUMNS) for x in (spans, firsts)])


def shared_windows(segments_: DataFrame, kinds: int = KINDS) -> DataFrame:
    """Intervals (``k1``, ``k2``, ``start``, ``stop``) of repeated windows in first segments."""
    kept = segments_.where("segment is not null")
    # Written, so that both sides of the join have shuffles of their own, which Spark can split at a hot gram.
    several = cut_lineage(kept.groupBy("gram").agg(F.count("*").alias("kinds")).where("kinds > 1"), "suffix-kinds", free=True)
    salts = F.ceil(F.col("kinds") / kinds)
    rows = kept.join(several, "gram").select(
        "gram", F.pmod(F.xxhash64("segment"), salts).cast("int").alias("salt"), (F.col("kinds") > kinds).alias("salted"), "k1", "k2", "start", "segment"
    )
    grouped = rows.repartition("gram", "salt").sortWithinPartitions("gram", "salt")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            # Whole groups in a row with some megabytes together; the last one may go on in the next batch.
            gram, salt = rows["gram"].to_numpy(), rows["salt"].to_numpy()
            heads = np.flatnonzero(np.concatenate([[True], (gram[1:] != gram[:-1]) | (salt[1:] != salt[:-1])]))
            weight = np.cumsum([len(x) for x in rows["segment"]])
            start = 0
            for head in heads[1:].tolist():
                if weight[head - 1] - (weight[start - 1] if start else 0) >= _TOGETHER:
                    yield _compare_windows(rows.iloc[start:head])
                    start = head
            if start < heads[-1]:
                yield _compare_windows(rows.iloc[start : heads[-1]])
            held = rows.iloc[heads[-1] :]
        if held is not None:
            yield _compare_windows(held)

    found = cut_lineage(grouped.mapInPandas(work, "k1 long, k2 long, start long, stop long, gram long, window long, open boolean"), "suffix-windows", free=True)
    spans = found.where("not open").select("k1", "k2", "start", "stop")
    firsts = found.where("open").select("gram", "window", F.struct("k1", "k2", "start").alias("place"))
    least = firsts.groupBy("gram", "window").agg(F.min("place").alias("least"), F.count("*").alias("n")).where("n > 1")
    later = firsts.join(least.drop("n"), ["gram", "window"]).where("place <> least")
    return spans.unionByName(later.select("place.k1", "place.k2", "place.start", (F.col("place.start") + WINDOW).alias("stop")))


# ---- all of it ------------------------------------------------------------------------------


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(``k1``, ``k2``, ``spans``): what to remove from each document that has something to remove.

    Each step is written, and what only the steps before it needed goes: tables with their scope, shuffles with their query.
    """
    spark, ordered = docs.sparkSession, _ordered(docs)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(size) // BUCKET_BYTES)
    result = scratch_dir(spark, "suffix-spans")
    with scratch_scope(spark):
        picked = scratch_dir(spark, "suffix-anchors")
        with scratch_scope(spark):
            by_doc = repeated_anchors(ordered, buckets).groupBy("k1", "k2").agg(F.collect_set("anchor").alias("anchors"))
            wanted = cut_lineage(by_doc, path=picked, free=True)
        merged = merge_segments(ordered, wanted, buckets)
        whole = merged.where("segment is null").select("k1", "k2", F.col("start").cast("long"), (F.col("start") + F.col("size")).cast("long").alias("stop"))
        spans = whole.unionByName(shared_windows(merged)).groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
        return cut_lineage(spans, path=result, free=True)


def cut(text: str | None, spans) -> tuple[bytes, int, int]:
    """What is left of a text, how many bytes went, and in how many runs."""
    raw = _bytes(text)
    if spans is None or not len(spans):
        return raw, 0, 0
    kept, at, gone, runs, stop = [], 0, 0, 0, -1
    for lo, hi in sorted((s["start"], s["stop"]) for s in spans):
        runs += lo > stop
        if hi > stop:
            begin = max(lo, at)
            kept.append(raw[at:begin])
            gone += hi - begin
            at = stop = hi
    kept.append(raw[at:])
    return b"".join(kept), gone, runs


def remove(docs: DataFrame, kept_col: str = "kept", removed_col: str = "n_removed", spans_col: str = "n_spans", as_text: bool = False) -> DataFrame:
    """Add the bytes left of ``text`` (or, ``as_text``, the text they make), and what was removed."""
    k1, k2, spans, result = (fresh(docs.columns, c) for c in ("k1", "k2", "spans", "cut"))
    found = repeated_spans(docs).select(F.col("k1").alias(k1), F.col("k2").alias(k2), F.col("spans").alias(spans))
    keyed = docs.withColumns({k1: F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)), k2: F.xxhash64("text")}).join(found, [k1, k2], "left")
    kind = "string" if as_text else "binary"

    @F.pandas_udf(f"kept {kind}, removed long, spans long")
    def apply(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, all_spans in batches:
            rows = [cut(t, s) for t, s in zip(texts, all_spans)]
            left = [r[0].decode("utf-8", "ignore") if as_text else r[0] for r in rows]
            yield pd.DataFrame({"kept": pd.Series(left, dtype=object), "removed": [r[1] for r in rows], "spans": [r[2] for r in rows]})

    cut_up = keyed.withColumn(result, apply.asNondeterministic()(F.col("text"), F.col(spans)))
    values = {kept_col: F.col(result)["kept"], removed_col: F.col(result)["removed"], spans_col: F.col(result)["spans"]}
    return cut_up.withColumns(values).drop(k1, k2, spans, result)


def keep_unrepeated(docs: DataFrame) -> DataFrame:
    """All documents, with ``text`` less what occurs before it, and ``n_chars`` to match."""
    kept, gone, runs = (fresh(docs.columns, c) for c in ("kept", "n_removed", "n_spans"))
    cut_up = remove(docs, kept, gone, runs, as_text=True)
    text = F.when(F.col(gone) > 0, F.col(kept)).otherwise(F.col("text"))
    size = F.when(F.col(gone) > 0, F.length(kept)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return cut_up.withColumns({"text": text, "n_chars": size}).select(*docs.columns)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without 100-byte strings that start earlier."""
    cut_up = remove(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut_up.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


OP8_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, s, substr(h, 2 * s + 1, 200) AS g FROM (SELECT doc_id, h, unnest(generate_series(0, len(h) // 2 - 100)) AS s FROM d)),
f AS (SELECT g, min((doc_id, s)) AS place FROM w GROUP BY g HAVING count(*) > 1),
dup AS (SELECT doc_id, s FROM w JOIN f USING (g) WHERE (doc_id, s) <> place),
marked AS (SELECT doc_id, s, s - lag(s, 1, -1000) OVER (PARTITION BY doc_id ORDER BY s) > 100 AS begins FROM dup),
grouped AS (SELECT doc_id, s, sum(begins::INT) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM marked),
runs AS (SELECT doc_id, min(s) AS lo, max(s) + 100 AS hi FROM grouped GROUP BY doc_id, run),
parts AS (
  SELECT doc_id, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS start, lo AS stop FROM runs
  UNION ALL SELECT doc_id, max(hi), NULL FROM runs GROUP BY doc_id
),
kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * start + 1, 2 * coalesce(stop - start, len(h))), '' ORDER BY start) AS h
  FROM parts JOIN d USING (doc_id) GROUP BY doc_id
),
sums AS (SELECT doc_id, sum(hi - lo)::BIGINT AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id)
SELECT d.doc_id, (len(d.h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN sums USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
