"""Grouping spelling variants: words that differ by one code point, found in indexes read in both directions.

Two words that differ by exactly one inserted, deleted or replaced code point agree in one half of the
first: its first ``m // 2`` code points or the rest. A search matches a half exactly and goes on
through the other with exactly one error, in an index over the delimited vocabulary
(:mod:`emberlink.llm.fm_index`): from the right end to the left, or, over reversed words, from the
left end to the right. A word that agrees in the first half is left to that search alone, so each
pair is found once.

The vocabulary is dealt out so that no index grows with the corpus: words that agree in a first half agree
in their first two code points, words that agree in a second half in their last three. Small keys share
an index; the words of a large key are cut into ``b`` parts, as indexed words and as queries, and
all ``b * b`` meetings of a part with a part are tasks of their own. Nothing is left out.

Counting is a map over documents: a run is damaged or not by its document and itself alone, so each
document handles its distinct runs once, and a task sums them before the shuffle.

Defined results: a null text has no run; a null ``doc_id`` counts as an empty string where runs are
damaged. Repeated rows count as often as they occur. Runs may be as long as a text. Extra columns are not
read. An empty table gives no words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from emberlink.llm.common import cut_lineage, table
from emberlink.llm.fm_index import Index, near_words

LEAST_LENGTH = 5
LEAST_COUNT = 3
FIRST, LAST = 2, 3  # code points that words with an equal half of LEAST_LENGTH // 2, or of the rest, must share
DAMAGE = 97
TIMES = 2  # how much more frequent a form must be
INDEX_CHARS = 500_000  # of an index, roughly
HELD = 200_000  # distinct words a task sums before it sends them on
_RUN = re.compile(rb"[a-z\xc0-\xff]+")
#: The letters, a to z and U+00C0 to U+00FF, as symbols from 1 on.
_LETTERS = bytes([*range(0x61, 0x7B), *range(0xC0, 0x100)])
_SYMBOLS = len(_LETTERS) + 1
_TO_SYMBOL = bytes(_LETTERS.find(bytes([b])) + 1 for b in range(256))


def damaged(run: bytes, prefix: int) -> bytes:
    """A run (Latin-1) as it counts in a document, whose id and colon have the checksum ``prefix``."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode("utf-8"), prefix)
    if h % DAMAGE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def count_words(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(``word``, ``n``) over all documents (``doc_id``, ``text``)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter[bytes] = Counter()

        def send() -> pd.DataFrame:
            words = [w.decode("latin-1") for w in total]
            return pd.DataFrame({"word": words, "n": list(total.values())})

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                if not text:
                    continue
                prefix = zlib.crc32(f"{doc_id or ''}:".encode())
                # One byte a code point; lower() on bytes touches A to Z only.
                for run, n in Counter(_RUN.findall(text.encode("latin-1", "replace").lower())).items():
                    if len(run) >= least_length:
                        word = damaged(run, prefix)
                        if len(word) >= least_length:
                            total[word] += n
                if len(total) > HELD:
                    yield send()
                    total.clear()
        if total:
            yield send()

    rows = docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(count, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def dealt_out(words: DataFrame, index_chars: int = INDEX_CHARS) -> DataFrame:
    """(``tile``, ``word``, ``n``, ``indexed``, ``asks``): which words meet in which index, and how.

    ``tile`` begins with ``p`` where first halves agree, with ``s`` where second halves do.
    """
    keys = F.array(
        F.struct(F.lit("p").alias("kind"), F.substring("word", 1, FIRST).alias("key")),
        F.struct(F.lit("s").alias("kind"), F.substring("word", -LAST, LAST).alias("key")),
    )
    keyed = words.select("word", "n", F.inline(keys))
    # At most one row for each string of two or three letters, summed before the shuffle.
    sizes = keyed.groupBy("kind", "key").agg(F.sum(F.length("word") + 1).alias("chars"))
    sizes = cut_lineage(sizes, "spelling-sizes")
    small = F.col("chars") * 4 < index_chars
    shared = sizes.where(small).groupBy("kind").agg(F.ceil(F.sum("chars") * 2 / index_chars).alias("tiles")).collect()
    tiles = F.create_map(*[F.lit(x) for r in shared for x in (r["kind"], r["tiles"])]) if shared else F.lit(None).cast("map<string,bigint>")
    plan = sizes.select(
        "kind",
        "key",
        F.when(small, F.lit(1)).otherwise(F.ceil(F.col("chars") / index_chars)).cast("int").alias("parts"),
        F.when(small, F.concat("kind", F.lit("|"), F.pmod(F.xxhash64("key"), tiles[F.col("kind")]))).otherwise(F.concat("kind", F.lit("="), "key")).alias("tile"),
    )
    b, part, block = F.col("parts"), F.pmod(F.xxhash64("word"), "parts").cast("int"), F.pmod(F.xxhash64("word", F.lit(1)), "parts").cast("int")
    met = keyed.join(plan, ["kind", "key"]).withColumns({"part": part, "block": block})
    cells = F.expr("array_distinct(concat(transform(sequence(0, parts - 1), i -> part * parts + i), transform(sequence(0, parts - 1), i -> i * parts + block)))")
    spread = met.select("word", "n", "tile", "part", "block", "parts", F.explode(cells).alias("cell"))
    return spread.select(
        F.concat("tile", F.lit("#"), "cell").alias("tile"),
        "word",
        "n",
        (F.floor(F.col("cell") / b) == F.col("part")).alias("indexed"),
        (F.col("cell") % b == F.col("block")).alias("asks"),
    )


def _meet(rows: pd.DataFrame) -> pd.DataFrame:
    """For each asking word of one tile: how many of its indexed words are near, and the most frequent of them."""
    from_left = rows["tile"].iat[0].startswith("p")
    words = [w.encode("latin-1") for w in rows["word"]]
    turned = [w.translate(_TO_SYMBOL)[:: -1 if from_left else 1] for w in words]
    indexed, asks = np.flatnonzero(rows["indexed"]), np.flatnonzero(rows["asks"])
    if not len(indexed) or not len(asks):
        return pd.DataFrame({"word": [], "n_near": [], "form_n": [], "form": []}, dtype=object)
    index = Index([turned[i] for i in indexed], _SYMBOLS)
    by_turned = indexed[sorted(range(len(indexed)), key=lambda i: turned[indexed[i]])]  # as the index numbers them
    size = np.array([len(words[i]) for i in asks])
    exact = size // 2 if from_left else size - size // 2
    place = np.empty(len(words), np.int64)
    place[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    n, out = rows["n"].to_numpy(), []
    for q, w in near_words(index, [turned[i] for i in asks], exact):
        mine, other = asks[q], by_turned[w]
        if not from_left:  # the search from the left has found these
            apart = np.fromiter((words[o][: len(words[m]) // 2] != words[m][: len(words[m]) // 2] for m, o in zip(mine.tolist(), other.tolist())), bool, len(mine))
            mine, other = mine[apart], other[apart]
        order = np.lexsort((place[other], -n[other], mine))
        mine, other = mine[order], other[order]
        first = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]])) if len(mine) else mine
        counts = np.diff(np.append(first, len(mine)))
        out.append(pd.DataFrame({"word": mine[first], "n_near": counts, "form_n": n[other[first]], "form": other[first]}))
    found, text = pd.concat(out, ignore_index=True), rows["word"].to_numpy(dtype=object)
    return found.assign(word=pd.Series(text[found["word"]], dtype=object), form=pd.Series(text[found["form"]], dtype=object))


def variants(words: DataFrame, times: int = TIMES, index_chars: int = INDEX_CHARS) -> DataFrame:
    """``words`` (``word``, ``n``; distinct) with ``form``, ``root``, ``n_near`` and ``form_n``.

    Words must be of the letters the counting takes, five or more of them.
    """
    words = cut_lineage(words.select("word", "n"), "spelling-words")
    met = dealt_out(words, index_chars).groupBy("tile").applyInPandas(_meet, "word string, n_near long, form_n long, form string")
    best = met.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best"))
    joined = words.join(best, "word", "left")
    chosen = -F.col("best.less") >= times * F.col("n")
    judged = cut_lineage(
        joined.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(chosen, F.col("best.form")).alias("form"),
            F.when(chosen, -F.col("best.less")).alias("form_n"),
        ),
        "spelling-forms",
    )
    return judged.join(_roots(judged, times), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(judged: DataFrame, times: int) -> DataFrame:
    """(``word``, ``root``) of the words that have a form.

    Along forms ``n`` grows by ``times`` at least, so no way is longer than the logarithm of the largest ``n``;
    each round doubles the steps taken.
    """
    up = judged.where("form is not null").select("word", F.col("form").alias("root"))
    top = judged.agg(F.max("n")).first()[0] or 1
    longest, steps = int(np.log(top) / np.log(times)) + 1, 1
    while steps < longest:
        up = cut_lineage(up, "spelling-roots")
        beyond = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        up = up.join(beyond, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        steps *= 2
    return up


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word of ``documents``, and the more frequent word it may be a misspelling of."""
    return variants(count_words(table(spark, sf_dir, "documents")))


OP11_SQL = r"""
WITH crc_table AS (
  SELECT list(list_reduce(generate_series(1, 8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k) ORDER BY k) AS t
  FROM (SELECT unnest(generate_series(0, 255))::BIGINT AS k)
),
runs AS (
  SELECT doc_id, run, count(*) AS times
  FROM (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents)
  GROUP BY ALL
),
coded AS (SELECT run, times, hex(encode(concat(doc_id, ':', run))) AS h FROM runs WHERE length(run) >= 5),
hashed AS (
  SELECT run, times, xor(4294967295, list_reduce(
    list_transform(generate_series(1, length(h), 2), lambda i: (strpos('0123456789ABCDEF', h[i]) - 1) * 16 + strpos('0123456789ABCDEF', h[i + 1]) - 1),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT)) AS h
  FROM coded, crc_table
),
counted AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, sum(times)::BIGINT AS n
  FROM hashed GROUP BY 1
),
words AS (SELECT word, n FROM counted WHERE length(word) >= 5 AND n >= 3),
gaps AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(generate_series(1, length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM gaps AS a JOIN gaps AS b ON a.rest = b.rest AND a.i = b.i AND length(a.word) = length(b.word) AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM gaps AS a JOIN words AS b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM gaps AS a JOIN words AS b ON a.rest = b.word
),
best AS (SELECT word, count(*) AS n_near, min((-other_n, other)) AS top FROM near GROUP BY word),
judged AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN -top[1] >= 2 * words.n THEN top[2] END AS form, CASE WHEN -top[1] >= 2 * words.n THEN -top[1] END AS form_n
  FROM words LEFT JOIN best USING (word)
),
way AS (
  WITH RECURSIVE w AS (SELECT word, form AS at FROM judged WHERE form IS NOT NULL UNION ALL SELECT w.word, j.form FROM w JOIN judged AS j ON j.word = w.at WHERE j.form IS NOT NULL)
  SELECT w.word, w.at AS root FROM w JOIN judged AS j ON j.word = w.at WHERE j.form IS NULL
)
SELECT judged.word, form, coalesce(root, judged.word) AS root, n, n_near, form_n FROM judged LEFT JOIN way USING (word)
"""
